"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import written


class Forest:
    """Union-find over the keys seen so far; the smallest key of a set is its root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.parent
        top = x
        while (nxt := up.get(top, top)) != top:
            top = nxt
        while (nxt := up.get(x, x)) != top:
            up[x], x = top, nxt
        return top

    def union(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _contract(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars; the forest is emitted and begun anew at ``most`` keys."""
    forest = Forest()

    def stars() -> pa.RecordBatch:
        keys = list(forest.parent)
        roots = [forest.root(k) for k in keys]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(roots, pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.union(a, b)
        if len(forest.parent) > most:
            yield stars()
            forest = Forest()
    yield stars()


def _to_minimum(links: DataFrame, small: bool) -> DataFrame:
    """Link every neighbour of a key to the least of them; ``small``: neighbours below the key, and the key itself."""
    both = links if small else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    # Written first: a join of two plain shuffles is one whose hot keys adaptive execution can split.
    least = written(least.select("a", F.least("a", "m").alias("m")), "least")
    joined = both.join(least, "a")
    if small:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    else:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a > b").distinct()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """``(a, b)`` links of long keys -> ``(key, root)`` for every key that has a link; the root is the least key.

    Links are first contracted within each partition, then two star steps a round make
    every set a star.  A round is written to the shared folder, so no lineage grows.
    A hub's links are a skewed join, which adaptive execution splits; sums are taken
    before the shuffle.  Null keys have no links; a repeated link counts once.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(links.mapInArrow(_contract, "a long, b long").distinct(), "links")
    before = None
    for _ in range(rounds):
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == before or now[0] == 0:
            return links.select(F.col("a").alias("key"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct())
        before = now
        links = written(_to_minimum(_to_minimum(links, small=False), small=True), "links")
    raise RuntimeError(f"links did not settle in {rounds} rounds")
