"""Exact best inner products by best-first search of metric trees.

*Metric.*  A vector ``x`` gets one more component, ``sqrt(M^2 - |x|^2)`` with ``M`` the largest norm, a query gets zero.
Their Euclidean distance then falls exactly as the inner product rises.

*Trees.*  Pivots from a bounded sample deal all rows into cells; a cell of more than ``TREE`` rows is dealt
further by hash, so neither a hot cell nor equal vectors overfill a tree.  Each tree is one task: pages of ``PAGE`` entries,
every node with its covering radius and the distances of its entries to the centre above them.  The pages are a
stored table that holds every row.

*Search.*  A query first searches one tree of its nearest pivot; the score it has then bounds the rest.  It goes
to the trees whose covering radius allows a better one.  There it takes nodes by their lower bound, nearest first; a
child's or entry's distance is computed only if the stored distances and the triangle inequality leave it open.  Queries
walk in blocks, so a page is one matrix product for all that reach it.  Scores are integers; the bounds, in
floating point, are widened by more than their error, so none is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import literal_array, written

SCALE = 64
PAGE = 128
FAN = 32
TREE = 4096
BLOCK = 4096
# Most pivots, and rows looked at for one pivot: the bound of what the driver sees and every task gets.
PIVOTS = 1024
SAMPLE = 4
# Error allowed to a distance, as a share of the largest norm.
SLACK = 1e-6
NO_ID = (1 << 63) - 1
LOWEST = -(1 << 63)


@dataclass(frozen=True)
class Space:
    """What all tasks know of the vectors: components, largest norm, largest component."""

    dim: int
    norm: float
    largest: float

    @property
    def slack(self) -> float:
        return SLACK * self.norm

    def matrix(self, lists: pa.Array) -> np.ndarray:
        """Lists of longs as rows, shorter ones with zeros behind."""
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.zeros((len(lists), self.dim), np.int64)
        out[np.arange(self.dim)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        return out

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(float)
        return np.concatenate([x, np.sqrt(np.maximum(self.norm**2 - (x**2).sum(1), 0))[:, None]], axis=1)

    def products(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exact inner products; beyond a long they count as its limit."""
        if self.largest**2 * self.dim < 2**53:
            return (q.astype(float) @ x.astype(float).T).astype(np.int64)
        exact = q.astype(object) @ x.astype(object).T
        return np.clip(exact, LOWEST, NO_ID).astype(np.int64)

    def reach(self, square: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Largest score at a distance of ``bound`` or more from queries with squared norm ``square``."""
        low = np.maximum(bound - 4 * self.slack, 0)  # a bound is made of three distances
        return (square + self.norm**2 - low**2) / 2 + self.slack**2 + 1e-9 * self.norm**2


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T, 0))


_PAGES = "tree long, node int, up int, center array<double>, radius double, up_dist double, rows array<long>, ids array<long>, vecs array<long>, dists array<double>"


def _build(space: Space, pivots: np.ndarray, page: int, fan: int):
    """Nodes of one tree; leaves hold entries, the others only their children's ``up``."""

    def run(table: pa.Table) -> pa.Table:
        v = space.matrix(table.column("v"))
        x, rows, ids = space.lifted(v), table.column("row").to_numpy(), table.column("id").to_numpy()
        tree = table.column("tree")[0].as_py()
        rng = np.random.default_rng(0)
        out: list[dict] = []

        def add(own: np.ndarray, center: np.ndarray, up: int, up_center: np.ndarray | None, depth: int = 0) -> None:
            far = distances(x[own], center[None])[:, 0]
            node = {
                "tree": tree, "node": len(out), "up": up, "center": center.tolist(), "radius": float(far.max()),
                "up_dist": 0.0 if up_center is None else float(distances(center[None], up_center[None])[0, 0])}
            leaf = {"rows": [], "ids": [], "vecs": [], "dists": []}
            out.append(node | leaf)
            if len(own) <= page:
                out[-1].update(rows=rows[own].tolist(), ids=ids[own].tolist(), vecs=v[own].reshape(-1).tolist(), dists=far.tolist())
                return
            picked = rng.choice(own, min(fan, -(-2 * len(own) // page)), replace=False)
            cell = distances(x[own], x[picked]).argmin(1)
            parts = [(own[cell == k], x[p]) for k, p in enumerate(picked) if (cell == k).any()]
            if len(parts) == 1 or depth > 50:  # equal vectors, or nearly: no pivot tells them apart
                parts = [(own[k:k + page], parts[0][1]) for k in range(0, len(own), page)]
            for part, pivot in parts:
                add(part, pivot, node["node"], center, depth + 1)

        add(np.arange(len(v)), pivots[tree >> 32], -1, None)
        return pa.Table.from_pylist(out, schema=_arrow(_PAGES))

    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    kinds |= {f"array<{k}>": pa.list_(t) for k, t in kinds.items()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


class Tree:
    """The pages of one tree, ready to be searched."""

    def __init__(self, space: Space, table: pa.Table):
        nodes = sorted(table.to_pylist(), key=lambda n: n["node"])
        self.space = space
        self.center = np.array([n["center"] for n in nodes])
        self.radius = np.array([n["radius"] for n in nodes])
        self.up_dist = np.array([n["up_dist"] for n in nodes])
        self.children: list[list[int]] = [[] for _ in nodes]
        for n in nodes[1:]:
            self.children[n["up"]].append(n["node"])
        self.leaf = [
            None if not n["rows"] else
            (np.array(n["rows"]), np.array(n["ids"]), np.array(n["vecs"], np.int64).reshape(len(n["rows"]), space.dim), np.array(n["dists"]))
            for n in nodes]

    def best(self, q: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """``(query, score, id, row)`` of the ``k`` best of each query with a score of ``least`` or more; not its ``own`` row."""
        space = self.space
        qf = np.concatenate([q.astype(float), np.zeros((len(q), 1))], axis=1)
        square = (qf**2).sum(1)
        kth = least.copy()
        found = tuple(np.zeros(0, np.int64) for _ in range(4))
        d0 = distances(qf, self.center[:1])[:, 0]
        # waiting: query, node, lower bound, distance to the node's centre
        wait = (np.arange(len(q)), np.zeros(len(q), int), np.maximum(d0 - self.radius[0], 0), d0)
        take = 1
        while True:
            open_ = space.reach(square[wait[0]], wait[2]) >= kth[wait[0]]
            wait = tuple(w[open_] for w in wait)
            if not len(wait[0]):
                return found
            order = np.lexsort((wait[2], wait[0]))
            wait = tuple(w[order] for w in wait)
            begin = np.flatnonzero(np.concatenate([[True], wait[0][1:] != wait[0][:-1]]))
            rank = np.arange(len(wait[0])) - np.repeat(begin, np.diff([*begin, len(wait[0])]))
            now, wait = tuple(w[rank < take] for w in wait), tuple(w[rank >= take] for w in wait)
            take = min(2 * take, 256)
            ahead, hits = [wait], [found]
            by_node = np.argsort(now[1], kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(now[1][by_node]) > 0, [True]]))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                at = by_node[low:high]
                node, qs, up = int(now[1][at[0]]), now[0][at], now[3][at]
                (hits if self.leaf[node] else ahead).append(
                    self._entries(node, qs, up, q, square, own, kth) if self.leaf[node] else self._kids(node, qs, up, qf, square, kth))
            wait = tuple(np.concatenate(w) for w in zip(*ahead, strict=True))
            if len(hits) > 1:
                found = tuple(np.concatenate(h) for h in zip(*hits, strict=True))
                order = np.lexsort((found[3], found[2], -found[1].astype(float), found[0])) if space.largest**2 * space.dim < 2**53 else np.array(
                    sorted(range(len(found[0])), key=lambda i: (found[0][i], -int(found[1][i]), found[2][i], found[3][i])), int)
                found = tuple(f[order] for f in found)
                begin = np.flatnonzero(np.concatenate([[True], found[0][1:] != found[0][:-1]])) if len(found[0]) else np.zeros(0, int)
                rank = np.arange(len(found[0])) - np.repeat(begin, np.diff([*begin, len(found[0])]))
                last = rank == k - 1
                kth[found[0][last]] = np.maximum(kth[found[0][last]], found[1][last])
                found = tuple(f[rank < k] for f in found)

    def _kids(self, node: int, qs, up, qf, square, kth):
        kids = np.array(self.children[node])
        cheap = np.abs(up[:, None] - self.up_dist[kids][None, :]) - self.radius[kids][None, :]
        open_ = self.space.reach(square[qs][:, None], cheap) >= kth[qs][:, None]
        some = open_.any(0)
        d = distances(qf[qs], self.center[kids[some]])
        bound = np.maximum(np.maximum(d - self.radius[kids[some]][None, :], cheap[:, some]), 0)
        a, b = np.nonzero(open_[:, some])
        return qs[a], kids[some][b], bound[a, b], d[a, b]

    def _entries(self, node: int, qs, up, q, square, own, kth):
        rows, ids, vecs, dists = self.leaf[node]
        open_ = self.space.reach(square[qs][:, None], np.abs(up[:, None] - dists[None, :])) >= kth[qs][:, None]
        some = open_.any(0)
        rows, ids = rows[some], ids[some]
        scores = self.space.products(q[qs], vecs[some])
        a, b = np.nonzero((scores >= kth[qs][:, None]) & (rows[None, :] != own[qs][:, None]))
        return qs[a], scores[a, b], ids[b], rows[b]


def _search(space: Space, k: int):
    schema = _arrow("q long, q_id long, score long, id long, row long")

    def run(pages: pa.Table, queries: pa.Table) -> pa.Table:
        if not pages.num_rows or not queries.num_rows:
            return schema.empty_table()
        own, own_id = queries.column("row").to_numpy(), queries.column("id").to_numpy()
        least = queries.column("least").to_numpy()
        q, score, ids, rows = Tree(space, pages).best(space.matrix(queries.column("v")), own, least, k)
        return pa.table([own[q], own_id[q], score, ids, rows], schema=schema)

    return run


_FOUND = "q long, q_id long, score long, id long, row long"


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``(row, id, v)`` of the vectors without null, infinite or undefined components; ``row`` tells equal rows apart."""
    vec = F.col(f"`{vec_col}`")
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(vec.isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.transform(vec, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    return written(rows, "vectors")


def top_k(
    vectors: DataFrame, is_query: Callable[[Column], Column], id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 20, scale: int = SCALE,
    tree: int = TREE, page: int = PAGE, fan: int = FAN, block: int = BLOCK, pivots: int = PIVOTS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products of each query row with all other rows.

    ``is_query`` is a condition on the id.  Components are ``floor(scale * x)``.  Vectors that are null or hold null or
    non-finite components take no part; an empty vector scores 0, and a shorter one counts as if zeros followed.  Ties go to the
    smaller id, a null id is the largest (it is found, but never a query unless the condition takes it).  Rows that repeat an
    id are rows of their own: each is found, and each query row has its own list.  A table of one row or none gives nothing.
    Scores and components beyond a long's range count as its limit.
    """
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    x = lambda f: F.aggregate("v", F.lit(0.0), f)
    own_id = F.when(F.col("id") != NO_ID, F.col("id"))
    asked = rows.where(F.coalesce(is_query(own_id), F.lit(False)))
    n, dim, square, largest = rows.agg(
        F.count("*"), F.max(F.size("v")), F.max(x(lambda s, c: s + c.cast("double") * c)), F.max(x(lambda s, c: F.greatest(s, F.abs(c.cast("double")))))).first()
    space = Space(max(dim or 0, 1), float(np.sqrt(square or 0.0)), largest or 0.0)
    many = int(min(pivots, max(1, -(-n // tree))))
    sample = rows.select("v", F.xxhash64("row").alias("h")).orderBy("h").limit(SAMPLE * many).select("v").toArrow().column(0)
    centers = space.lifted(np.unique(space.matrix(sample), axis=0)) if n else np.zeros((1, space.dim + 1))
    centers = np.random.default_rng(0).permutation(centers)[:many]

    def dealt(batches):
        for b in batches:
            d = distances(space.lifted(space.matrix(b.column(2))), centers)
            cell = d.argmin(1) if len(d) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int64)), pa.array(d[np.arange(len(d)), cell])], [*b.schema.names, "cell", "dist"])

    cells = written(rows.mapInArrow(dealt, "row long, id long, v array<long>, cell long, dist double"), "cells")
    # a row a pivot
    sizes = {c: (m, r) for c, m, r in cells.groupBy("cell").agg(F.count("*"), F.max("dist")).collect()}
    slices = [max(1, -(-sizes.get(c, (0, 0))[0] // tree)) for c in range(len(centers))]
    radius = np.array([sizes.get(c, (0, -1.0))[1] for c in range(len(centers))])
    slice_of = F.pmod(F.xxhash64("row"), F.get(literal_array(slices, "long"), F.col("cell").cast("int")))
    treed = cells.withColumn("tree", F.shiftleft("cell", 32) + slice_of).select("tree", "row", "id", "v")
    pages = written(treed.groupBy("tree").applyInArrow(_build(space, centers, page, fan), _PAGES), "pages")

    asked = written(asked, "queries")
    blocks = -(-max(1, asked.count()) // block)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)))
    index = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))

    def found_in(wanted: DataFrame) -> DataFrame:
        return index.groupBy("tree", "block").cogroup(wanted.groupBy("tree", "block")).applyInArrow(_search(space, k), _FOUND)

    def nearest(batches):
        for b in batches:
            q = space.matrix(b.column(2)).astype(float)
            d = distances(np.concatenate([q, np.zeros((len(q), 1))], axis=1), centers)
            d[:, radius < 0] = np.inf  # cells without rows
            cell = d.argmin(1) if len(d) else np.zeros(0, int)
            part = b.column(0).to_numpy() % np.array(slices)[cell]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array((cell.astype(np.int64) << 32) + part), pa.array(np.full(len(q), LOWEST))], [*b.schema.names, "tree", "least"])

    kind = "row long, id long, v array<long>, block long, tree long, least long"
    seeds = found_in(asked.mapInArrow(nearest, kind)).groupBy("q").agg(F.min("score").alias("score"), F.count("*").alias("m"))
    least = written(seeds.where(F.col("m") == k).select(F.col("q").alias("row"), F.col("score").alias("least")), "least")

    def allowed(batches):
        for b in batches:
            q = space.matrix(b.column(2)).astype(float)
            d = distances(np.concatenate([q, np.zeros((len(q), 1))], axis=1), centers)
            bound = space.reach((q**2).sum(1)[:, None], d - radius[None, :])
            a, c = np.nonzero((bound >= b.column("least").to_numpy()[:, None]) & (radius >= 0)[None, :])
            times = np.array(slices)[c]
            a, c = np.repeat(a, times), np.repeat(c, times)
            part = np.arange(len(c)) - np.repeat(np.cumsum(times) - times, times)
            for low in range(0, len(a), 10_000):
                own = b.take(pa.array(a[low:low + 10_000]))
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(n) for n in ("row", "id", "v", "block")), pa.array((c.astype(np.int64) << 32)[low:low + 10_000] + part[low:low + 10_000]), own.column("least")],
                    ["row", "id", "v", "block", "tree", "least"])

    bounded = asked.join(least, "row", "left").select("row", "id", "v", "block", F.coalesce("least", F.lit(LOWEST)).alias("least"))
    found = found_in(bounded.mapInArrow(allowed, kind))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.when(F.col("q_id") != NO_ID, F.col("q_id")).alias("query_id"), "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias("vec_id"), "score")

