"""Line deduplication over sorted line hashes, with bitmaps of the lines to keep.

Every line key becomes a 128-bit hash with its document and position.  The hashes are
range-partitioned and sorted by (hash, document, position), so a task streams each hash's
occurrences in order and knows its first document.  The range runs over all three columns,
so a line that a third of all documents share is spread over many tasks: what a task
cannot know is only whether its first hash began in an earlier one.  Those rows are left
open and decided by one small table of the first documents at the partitions' edges.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import as_bytes, written

MIN_CHARS = 10


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip().lower()


def _hashes(min_chars: int):
    """(id, position, two halves of the hash) of every line whose key is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at, digests = [], [], bytearray()
            for k, text in enumerate(batch.column(1)):
                for n, line in enumerate(text.as_py().split(b"\n")):
                    key = line_key(line)
                    # a code point has at most four bytes; only short keys need counting
                    if len(key) >= 4 * min_chars or len(key.decode("utf-8", "surrogateescape")) >= min_chars:
                        row.append(k)
                        at.append(n)
                        digests += xxhash.xxh3_128_digest(key)
                if len(row) > 200_000 or k == batch.num_rows - 1:
                    halves = np.frombuffer(bytes(digests), ">i8").astype(np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(row, pa.int64())), pa.array(at, pa.int32()),
                        pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                    ], ["doc", "pos", "h1", "h2"])
                    row, at, digests = [], [], bytearray()

    return run


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to drop, rows left open, and the edges' first documents, from sorted rows.

    ``state`` 0: drop; 1: open, of the task's first hash; 2: edge, ``doc`` is the first of this hash here.
    """
    opening = held = first = kind = None

    def out(doc, pos, h1, h2, state):
        return pa.RecordBatch.from_arrays(
            [doc, pos, pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(state, pa.int32())],
            ["doc", "pos", "h1", "h2", "state"])

    for batch in batches:
        doc, pos = batch.column(0), batch.column(1)
        h1, h2 = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        if not len(h1):
            continue
        kind = doc.type
        begins = np.ones(len(h1), bool)
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if opening is None:
            opening = (int(h1[0]), int(h2[0]))
            yield out(doc.slice(0, 1), pos.slice(0, 1), h1[:1], h2[:1], [2])
        # the first document of each row's hash: at the row where its run begins, or carried over
        firsts = doc.take(pa.array(np.maximum.accumulate(np.where(begins, np.arange(len(h1)), 0))))
        if (int(h1[0]), int(h2[0])) == held:
            going_on = int(np.argmax(begins[1:])) + 1 if begins[1:].any() else len(h1)
            firsts = pa.concat_arrays([pa.array([first] * going_on, kind), firsts.slice(going_on)])
        is_open = (h1 == opening[0]) & (h2 == opening[1])
        keep = is_open | ~pc.equal(doc, firsts).to_numpy(zero_copy_only=False)
        at = pa.array(np.flatnonzero(keep))
        yield out(doc.take(at), pos.take(at), h1[keep], h2[keep], is_open[keep].astype(np.int32))
        held, first = (int(h1[-1]), int(h2[-1])), firsts[len(firsts) - 1].as_py()
    if held is not None and held != opening:
        yield out(pa.array([first], kind), pa.array([0], pa.int32()), [held[0]], [held[1]], [2])


def _bitmap(dropped: list[int]) -> bytes:
    """Bits of the lines up to the last dropped one; the last byte is filled up with kept ones."""
    keep = np.ones(-(-(max(dropped) + 1) // 8) * 8, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def kept_lines(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """One boolean per line; lines past the bitmap's end are kept."""
    keep = np.ones(n_lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
        keep[:len(bits)] = bits
    return keep


def apply_bitmap(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """Kept text, lines before, lines dropped."""
    lines = text.split(b"\n")
    if bitmap is None:
        return text, len(lines), 0
    kept = [line for line, keep in zip(lines, kept_lines(bitmap, len(lines)).tolist(), strict=True) if keep]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc, pos)`` of every line whose key a document with a smaller id holds too."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("doc"), as_bytes(F.col(f"`{text_col}`")).alias("text"))
    hashed = rows.mapInArrow(_hashes(min_chars), f"doc {kind}, pos int, h1 long, h2 long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = hashed.repartitionByRange(parts, "h1", "h2", "doc", "pos").sortWithinPartitions("h1", "h2", "doc", "pos")
    streamed = written(ordered.mapInArrow(_first_occurrences, f"doc {kind}, pos int, h1 long, h2 long, state int"), "lines")
    # at most two rows a partition, so it may be broadcast
    edges = streamed.where("state = 2").groupBy("h1", "h2").agg(F.min("doc").alias("first"))
    opened = streamed.where("state = 1").join(F.broadcast(edges), ["h1", "h2"]).where("doc > first")
    return streamed.where("state = 0").select("doc", "pos").unionByName(opened.select("doc", "pos"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc, n_dropped, keep)`` of the documents that lose lines; ``keep`` is a compressed bitmap of its lines.

    Keys shorter than ``min_chars`` code points never count.  Null and empty texts are one empty line.
    A document without an id neither loses lines nor takes them from others; rows that repeat
    an id are one document, whose positions lose their line in each of the rows.
    """
    drops = dropped_lines(docs, id_col, text_col, min_chars)
    # one document's positions: bounded by its own text
    lists = drops.groupBy("doc").agg(F.collect_set("pos").alias("gone"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = [g.as_py() for g in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(map(len, gone), pa.int64()),
                pa.array([_bitmap(g) for g in gone], pa.binary()),
            ], ["doc", "n_dropped", "keep"])

    return lists.mapInArrow(run, f"doc {kind}, n_dropped long, keep binary")


def kept_text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(id_col, n_lines, n_dropped, kept_sha256)`` of every row."""
    maps = keep_bitmaps(docs, id_col, text_col, min_chars)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [apply_bitmap(t.as_py(), b.as_py()) for t, b in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()),
                pa.array([hashlib.sha256(d[0]).hexdigest() for d in done], pa.string()),
            ], ["id", "n_lines", "n_dropped", "kept_sha256"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), as_bytes(F.col(f"`{text_col}`")).alias("text"))
    joined = rows.join(maps, "doc", "left").select("doc", "text", "keep")
    return joined.mapInArrow(run, f"id {kind}, n_lines long, n_dropped long, kept_sha256 string").withColumnRenamed("id", id_col)
