"""SimHash near-duplicates, found with tables of distances to reference fingerprints.

A document's fingerprint is the bitwise majority of its shingles' hashes.  Two
fingerprints are linked when at most ``radius`` bits differ; linked ones form groups.

How links are found.  The Hamming distance to a reference is a coordinate, and by the
triangle inequality no coordinate of two linked fingerprints differs by more than
``radius``.

* *Candidates.*  The 64 bits are cut into blocks.  References that differ from zero in
  one bit of a block give coordinates that tell, and are told by, the block's bits.  At
  most ``radius`` blocks of a linked pair differ, so on all coordinates of the other
  blocks the difference is zero: the pair meets in the table keyed by those blocks.
* *Discard.*  Within a key each task tabulates once the distances of its fingerprints to
  ``REFERENCES`` and discards pairs whose largest coordinate difference is over ``radius``.
* *Verify.*  The differing bits of the survivors are counted.

Equal fingerprints are merged first, so copies cost nothing here.  A key held by more
than ``in_task`` different fingerprints is not handed to a task.  Its fingerprints are
linked by common neighbours: a pair within ``radius`` has a point within half of it of both,
and all fingerprints near one point are within ``radius`` of each other, so each links to
the least one.  That is exact, and its rows grow in proportion to the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import similar
from millrace.llm.components import Forest, components
from millrace.llm.shared import as_bytes, literal_array, written

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCKS = 6
IN_TASK = 20_000


def _references() -> np.ndarray:
    """Reference fingerprints by a rule: bit i of reference j is the parity of i AND j.

    Any two of them differ in half the bits, so their coordinates are least related.
    """
    i = np.arange(BITS, dtype=np.uint64)
    rows = [np.bitwise_count(i & np.uint64(j)) & 1 for j in range(1, BITS, 3)]
    return np.array([sum(int(bit) << k for k, bit in enumerate(row)) for row in rows], dtype=np.uint64)


REFERENCES = _references()


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED, chunk: int = 1 << 15) -> int:
    """Majority bits of the XXH64 hashes of the word shingles of a UTF-8 text; 0 for a text without words."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = [0, *accumulate(len(w) + 1 for w in words)]
    n = max(1, len(words) - shingle + 1)
    span = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for low in range(0, n, chunk):
        at = range(low, min(n, low + chunk))
        hashes = np.fromiter((digest(joined[ends[k]:ends[k + span] - 1], seed) for k in at), ">u8", len(at))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, mark, fp)`` per row: a hash of the whole text, and the fingerprint as a signed long.

    A null text is one without words.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["id", "mark", "fp"])

    text = F.col(f"`{text_col}`")
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("mark"), as_bytes(text).alias("text"))
    return ids.mapInArrow(run, f"id {kind.simpleString()}, mark long, fp long")


def _masks(blocks: int, radius: int) -> list[int]:
    """For each choice of blocks - radius blocks, the mask of their bits, as signed longs."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(block, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _link_sorted(radius: int):
    """Links within runs of equal (table, key) rows, as a spanning forest of each run."""

    def linked(table: np.ndarray, key: np.ndarray, fp: np.ndarray) -> tuple[list[int], list[int]]:
        near = np.bitwise_count(fp[:, None] ^ REFERENCES[None, :]).astype(np.int8)  # the distance table
        forest, a, b = Forest(), [], []
        root = np.arange(len(fp))
        at, step = np.arange(len(fp)), 0
        while len(at):
            step += 1
            at = at[at + step < len(fp)]
            at = at[(table[at] == table[at + step]) & (key[at] == key[at + step])]
            pair = at[root[at] != root[at + step]]
            for low in range(0, near.shape[1], 4):  # a few coordinates at a time; most pairs go with the first
                apart = np.abs(near[pair, low:low + 4] - near[pair + step, low:low + 4]).max(axis=1, initial=0)
                pair = pair[apart <= radius]
            pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + step]) <= radius]
            for x, y in zip(pair.tolist(), (pair + step).tolist()):
                if forest.union(x, y):
                    a.append(x)
                    b.append(y)
            if len(pair):
                for x in list(forest.parent):
                    root[x] = forest.root(x)
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(rows: np.ndarray) -> pa.RecordBatch:
            a, b = linked(rows[0], rows[1], rows[2].view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(rows[2][a]), pa.array(rows[2][b])], ["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            rows = np.concatenate([*held, rows], axis=1) if held else rows
            # the last run may go on in the next batch
            last = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield out(rows[:, :cut])
            held = [rows[:, cut:]]
        if held:
            yield out(held[0])

    return run


def _ball(radius: int) -> Column:
    """All masks of at most ``radius`` bits, as an array of longs."""
    masks = [sum(1 << k for k in c) for n in range(radius + 1) for c in combinations(range(BITS), n)]
    return literal_array((m - (1 << BITS) if m >> (BITS - 1) else m for m in masks), "bigint")


def near_links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, in_task: int = IN_TASK) -> DataFrame:
    """``fp`` (different longs) -> ``(a, b)`` links whose components are those of all pairs within ``radius`` bits.

    ``blocks`` sets the work, never the result: more blocks mean more tables with longer
    keys (6: 15 tables of 21 bits, 8: 70 of 32 bits), for billions of fingerprints.
    """
    if blocks <= radius or radius % 2:
        raise ValueError("radius must be even and below the number of blocks")
    masks = _masks(blocks, radius)
    keyed = distinct.select("fp", F.posexplode(F.transform(literal_array(masks, "bigint"), lambda m: m.bitwiseAND(F.col("fp")))).alias("t", "key"))
    # Written before they are joined: a join of two plain shuffles is one whose hot keys adaptive execution can split.
    counts = written(keyed.groupBy("t", "key").count().where("count > 1"), "counts")
    shared = written(keyed.join(counts, ["t", "key"]), "keyed")
    links = (
        shared.where(F.col("count") <= in_task).select("t", "key", "fp").repartition("t", "key")
        .sortWithinPartitions("t", "key", "fp").mapInArrow(_link_sorted(radius), "a long, b long")
    )
    crowded = shared.where(F.col("count") > in_task)
    if crowded.isEmpty():
        return links
    masks = _ball(radius // 2)
    points = crowded.select("fp").distinct().select("fp", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top")
    star = points.join(least.select("point", "b"), "point").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return links.unionByName(star)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, radius: int = RADIUS,
    blocks: int = BLOCKS, in_task: int = IN_TASK, similarity: float | None = None,
) -> DataFrame:
    """``(id_col, mark, fp, component_id, least_mark)`` for every row; ``component_id`` is the least id of the group.

    Rows that repeat an id belong to the group of each of their texts.  A null id keeps its
    row and never names a group that has another id.  Null and empty texts have fingerprint zero
    and form a group like any other.  ``mark`` is a hash of the text, ``least_mark`` the group's least.  Other columns are not read.

    With ``similarity`` the groups are those of all pairs whose shingle sets have at least that Jaccard similarity, counted exactly, and ``fp``
    names the set.  The fingerprints' links within ``radius`` come first and each is verified; pairs that no radius
    reaches that tables can serve are added by shared shingles (:mod:`millrace.llm.similar`).
    """
    found = fingerprints(docs, id_col, text_col, shingle) if similarity is None else similar.set_prints(docs, id_col, text_col, shingle)
    prints = written(found, "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("least"), F.min("mark").alias("least_mark")), "distinct")
    if similarity is None:
        links = near_links(distinct.select("fp"), radius, blocks, in_task)
    else:
        links = similar.similar_links(docs, text_col, prints, shingle, similarity, lambda bits: near_links(bits, radius, blocks, in_task))
    sets = components(links).withColumnRenamed("key", "fp")
    rooted = written(distinct.join(sets, "fp", "left").select("fp", "least", "least_mark", F.coalesce("root", "fp").alias("root")), "rooted")
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("least_mark").alias("least_mark")), "named")
    by_print = rooted.select("fp", "root").join(named, "root").select("fp", "component_id", "least_mark")
    return prints.join(by_print, "fp").select(F.col("id").alias(id_col), "mark", "fp", "component_id", "least_mark")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, radius: int = RADIUS,
    similarity: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` that name their near-duplicate group, with all columns.

    A group without any id keeps the text with the least hash.  Rows that repeat both id and text are the
    same document and stay together.
    """
    named = near_duplicates(docs, id_col, text_col, shingle=shingle, radius=radius, similarity=similarity)
    names = F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull() & (F.col("mark") == F.col("least_mark")))
    keep = named.where(names).select(F.col(id_col).alias("_kept_id"), F.col("mark").alias("_kept_mark")).distinct()
    same = docs[id_col].eqNullSafe(keep["_kept_id"]) & (F.xxhash64(docs[text_col]) == keep["_kept_mark"])
    return docs.join(keep, same, "left_semi")
