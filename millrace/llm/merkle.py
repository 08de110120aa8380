"""Hash trees over the rows of each group, and the proof of every row by pointer jumping.

*Tree.*  A row's leaf is the digest of its fields.  In a group the leaves stand in order of id; runs of
``FAN`` nodes become their parent until one is left, the group's root.  The group roots, in order of group,
make the tree of the whole table in the same way.  A task gets the nodes below one ancestor ``BLOCK`` levels up,
at most ``FAN ** BLOCK``, so neither a group nor a level is ever in one task.

*Proofs.*  Each node first holds the segment of siblings towards its parent.  A self-join then doubles the
distance: a node takes over the ancestor of its ancestor and appends that one's segment.  After as many
rounds as the logarithm of the height every leaf has reached the root.  Segments are bytes, 32 a sibling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import as_bytes, remove, written

FAN = 3
BLOCK = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Number of the tree over the group roots; groups count from 0.
TOP = -1

_NODE = ("tree", "level", "place")
_UP = ("up_tree", "up_level", "up_place")


def field(column: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and value, as bytes."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string").cast("binary"), F.lit(b":"), value.cast("binary")), F.lit(b"-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def height(n: int, fan: int = FAN) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def parent(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


def step(own: int, siblings: Sequence[bytes]) -> bytes:
    """One level of a segment: a byte with the own place and the number of siblings, then these."""
    return bytes([own << 4 | len(siblings)]) + b"".join(siblings)


def steps(segment: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(segment):
        own, n = segment[at] >> 4, segment[at] & 15
        yield own, [segment[at + 1 + 32 * k:at + 33 + 32 * k] for k in range(n)]
        at += 1 + 32 * n


def fold(leaf: bytes, segment: bytes, stop: int | None = None) -> bytes:
    """The digest reached from ``leaf`` with its siblings, after ``stop`` levels or all."""
    node = leaf
    for k, (own, siblings) in enumerate(steps(segment)):
        if k == stop:
            break
        node = parent([*siblings[:own], node, *siblings[own:]])
    return node


def numbered(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``place`` (from 0, in order), ``n`` (rows) and ``tree`` (from 0) of their group; no task holds a group.

    Rows are range-partitioned by group and order, so counts by (partition, group) give each partition's first place.
    ``order`` should tell all rows apart, else equal ones are one task's.
    """
    rows = rows.repartitionByRange(F.col(group).asc_nulls_first(), *order).sortWithinPartitions(F.col(group).asc_nulls_first(), *order)
    serial = F.monotonically_increasing_id()  # partition and row in it
    rows = written(rows.withColumns({"part": F.shiftright(serial, 33), "at": serial.bitwiseAND((1 << 33) - 1)}), name)
    held = rows.groupBy("part", group).agg(F.count("*").alias("m"), F.min("at").alias("low"))
    # a group has a row for each partition here, however many rows it has in them
    before = Window.partitionBy(group).orderBy("part")
    held = held.withColumns({
        "shift": F.sum("m").over(before) - F.col("m") - F.col("low"), "n": F.sum("m").over(Window.partitionBy(group))})
    if group == "tree":
        held = held.select(F.col("part").alias("p"), F.col("tree").alias("g"), "shift", "n")
    else:
        one = held.groupBy(group).agg(F.min("part").alias("first")).withColumn("tree", F.lit(TOP).cast("long"))
        ranks = numbered(one, "tree", [group], f"{name}_groups").select(F.col(group).alias("g"), F.col("place").alias("tree"))
        held = held.withColumnsRenamed({group: "h", "part": "p"}).join(ranks, F.col("h").eqNullSafe(F.col("g"))).select("p", "g", "tree", "shift", "n")
    joined = rows.join(held, (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")))
    return joined.withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "p", "g", "shift")


_CARRIED = "id {kind}, leaf binary, changed binary"
_COLUMNS = "tree long, level int, place long, n long, digest binary, seg binary, up_tree long, up_level int, up_place long, ended boolean, " + _CARRIED


def _grown(nodes: DataFrame, kind: str, fan: int, block: int, name: str) -> DataFrame:
    """Nodes of the next ``block`` levels: with ``seg`` where the parent is among them, the others without.

    A parent that is a group's root goes by its place in the tree above; ``ended`` marks a root.
    """
    schema = _COLUMNS.format(kind=kind)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        tree, base, n = (table.column(c)[0].as_py() for c in ("tree", "level", "n"))
        end = height(n, fan)
        first, digests = table.column("place")[0].as_py(), table.column("digest").to_pylist()
        out: list[list] = [[] for _ in range(8)]
        for level in range(base, min(base + block, end) + 1):
            up = [parent(digests[k:k + fan]) for k in range(0, len(digests), fan)] if level < min(base + block, end) else []
            root_next = level + 1 == end and tree != TOP
            for k, digest in enumerate(digests):
                low = k - k % fan
                segment = step(k % fan, [*digests[low:k], *digests[k + 1:low + fan]]) if up else None
                ahead = (None, None, None) if not up else (TOP, 0, tree) if root_next else (tree, level + 1, (first + k) // fan)
                for held, value in zip(out, (level, first + k, digest, segment, *ahead, level == end), strict=True):
                    held.append(value)
            digests, first = up, first // fan
        rows = len(out[0])
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.bool_())
        columns = dict(zip(
            ("level", "place", "digest", "seg", "up_tree", "up_level", "up_place", "ended"), (pa.array(v, t) for v, t in zip(out, kinds, strict=True)), strict=True))
        columns |= {"tree": pa.array([tree] * rows, pa.int64()), "n": pa.array([n] * rows, pa.int64())}
        for c in ("id", "leaf", "changed"):  # what the given nodes carry; those made here carry nothing
            own = table.column(c)
            columns[c] = pa.chunked_array([*own.chunks, pa.nulls(rows - table.num_rows, own.type)], own.type)
        names = [f.split()[0] for f in schema.split(", ")]
        return pa.table([columns[c] for c in names], names)

    block_of = F.floor(F.col("place") / fan**block)
    return written(nodes.groupBy("tree", block_of.alias("block")).applyInArrow(run, schema), name)


def _tree(nodes: DataFrame, kind: str, most: int, fan: int, block: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """``(frames of nodes with their segment, roots)`` of trees of at most ``most`` leaves."""
    linked, ended, passes = [], [], max(1, -(-height(most, fan) // block))
    for k in range(passes):
        grown = _grown(nodes, kind, fan, block, f"{name}_{k}")
        linked.append(grown.where("seg IS NOT NULL"))
        # trees that have their root wait while the others grow on
        ended.append(grown.where("ended"))
        nodes = grown.where("seg IS NULL AND NOT ended")
    return linked, reduce(DataFrame.unionByName, ended)


def proofs(leaves: DataFrame, kind: str, fan: int = FAN, block: int = BLOCK) -> tuple[DataFrame, bytes | None]:
    """``(id, leaf, changed, n, seg)`` of every leaf, ``n`` the rows of its group, its segment reaching the root; and the root.

    ``leaves``: columns ``id, part_of, leaf, changed``.
    """
    leaves = written(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = numbered(leaves, "part_of", ["id", "leaf", "row"], "sorted")
    nodes = written(placed.select("tree", F.lit(0).alias("level"), "place", "n", F.col("leaf").alias("digest"), "id", "leaf", "changed"), "placed")
    most, groups = nodes.agg(F.max("n"), F.max("tree")).first()
    if most is None:
        return nodes.select("id", "leaf", "changed", "n", F.lit(b"").alias("seg")), None
    links, roots = _tree(nodes, kind, most, fan, block, "nodes")
    # A group's root is a leaf of the tree above, and carries the row if it is one itself.
    tops = roots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"), F.lit(groups + 1).cast("long").alias("n"),
        "digest", "id", "leaf", "changed")
    more, root = _tree(tops, kind, groups + 1, fan, block, "top")
    root = written(root, "root")
    keep = [*_NODE, *_UP, "id", "leaf", "changed", "n", "seg"]
    # a row alone in its group has its place in the tree above, but no group's level below it
    more = [df.withColumn("n", F.lit(1).cast("long")) for df in more]
    all_links = reduce(DataFrame.unionByName, [df.select(keep) for df in [*links, *more]])

    end = height(groups + 1, fan)
    farthest = height(most, fan) + end
    open_ = ~((F.col("up_tree") == TOP) & (F.col("up_level") == end))
    reached, distance, held = all_links, 1, None
    while distance < farthest:
        ahead = reached.select(*(F.col(c).alias(f"x_{c}") for c in (*_NODE, *_UP, "seg")))
        last = 2 * distance >= farthest
        moving = reached.where(open_)
        if last:  # nobody asks the inner nodes again
            moving = moving.where("leaf IS NOT NULL")
        moved = moving.join(ahead, [F.col(u) == F.col(f"x_{c}") for u, c in zip(_UP, _NODE, strict=True)])
        moved = moved.select(
            *_NODE, *(F.col(f"x_{u}").alias(u) for u in _UP), "id", "leaf", "changed", "n", F.concat("seg", "x_seg").alias("seg"))
        still = reached.where(~open_)
        now = moved.unionByName(still.where("leaf IS NOT NULL") if last else still)
        distance *= 2
        if last:
            reached = now
            break
        now = written(now, f"reached_{distance}")
        if held is not None:
            remove(held)
        reached = held = now
    lone = root.where("leaf IS NOT NULL").select("id", "leaf", "changed", F.lit(1).cast("long").alias("n"), F.lit(b"").alias("seg"))
    ends = reached.where("leaf IS NOT NULL").select("id", "leaf", "changed", "n", "seg").unionByName(lone)
    return ends, root.select("digest").first()[0]


def manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS, *, tampered: dict[str, Column] | None = None,
    fan: int = FAN, block: int = BLOCK,
) -> DataFrame:
    """``(id_col, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row, digests as lowercase hex.

    ``tampered`` gives fields other values than those the tree was built of; the row's leaf is then made of these and
    folded with the stored siblings.  Null fields are ``-``; a null group is a group of its own, the first; empty
    text is a field of no bytes.  Rows without an id come first in their group.  Rows that repeat an id stand next to each
    other in order of their leaf; each has its own place and proof, and rows equal in all fields are interchangeable.  A
    table of one row has its leaf as root and the proof of nothing.  An empty table gives no rows.  Only the named
    columns are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    own = [F.col(f"`{c}`") for c in fields]
    changed = [(tampered or {}).get(c, v) for c, v in zip(fields, own, strict=True)]
    leaves = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").alias("part_of"), leaf_digest(own).alias("leaf"),
        (leaf_digest(changed) if tampered else F.lit(None).cast("binary")).alias("changed"))
    leaves = leaves.withColumn("changed", F.when(F.col("changed") != F.col("leaf"), F.col("changed")))
    ends, root = proofs(leaves, kind, fan, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for leaf, changed, n, seg in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True):
                proof = hashlib.sha256(b"".join(s.hex().encode() for _, siblings in steps(seg) for s in siblings)).hexdigest()
                folded = fold(leaf if changed is None else changed, seg)
                values = (leaf.hex(), fold(leaf, seg, height(n, fan)).hex(), root.hex(), proof, folded.hex(), folded == root)
                for held, value in zip(out, values, strict=True):
                    held.append(value)
            kinds = [pa.string()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))],
                ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return ends.select("id", "leaf", "changed", "n", "seg").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def stripped_of_newlines(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """The tampering of the manifest query: ids whose checksum is even lose the line ends of their text."""
    odd = F.crc32(as_bytes(F.col(f"`{id_col}`").cast("string"))) % 2 != 0
    text = F.col(f"`{text_col}`")
    return {text_col: F.when(F.col(f"`{id_col}`").isNull() | odd, text).otherwise(F.replace(text, F.lit("\n"), F.lit("")))}
