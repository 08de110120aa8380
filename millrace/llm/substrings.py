"""Passages that repeat across documents, by hashes of their clauses, removed by their place in the original text.

A text is cut into units: clauses (at ``.!?,;:`` and line ends), lines or paragraphs, each normalised and hashed.  One
aggregation finds the earliest unit of every hash by rank (document, place); the units an earlier one equals are
marked, and a run of marked units next to each other is removed when it has ``min_words`` words together.  So a passage
is found wherever it stands in a line, and a common phrase alone is left.

Rows carry a digest and a place; what is marked is joined to the texts as unit numbers.  The least rank is found before the
shuffle, and the join is one that adaptive execution splits, so a unit which a third of all rows hold needs no task of
its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import as_bytes, written

MIN_WORDS = 25
# Text of a unit, without what ends it.
UNITS = {"clause": re.compile(rb"[^.!?,;:\n]+"), "line": re.compile(rb"[^\n]+"), "paragraph": re.compile(rb"[^\n]+(?:\n[^\n]*[^\s][^\n]*)*")}
ENDS = b".!?,;:\n"


def units(text: bytes, unit: str = "clause") -> list[tuple[int, int, bytes]]:
    """First byte, the one past the end, and the words joined by spaces, of every unit that has a word."""
    found = []
    for m in UNITS[unit].finditer(text):
        words = m.group().lower().split()  # bytes: A-Z and ASCII white space only
        if words:
            found.append((m.start(), m.end(), b" ".join(words)))
    return found


def _digests(unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            row, places, digests = [], [], bytearray()
            for k, value in enumerate(batch.column(1)):
                found = units(value.as_py(), unit)
                row += [k] * len(found)
                places += range(len(found))
                for _, _, key in found:
                    digests += digest(key)
                if len(row) > 200_000 or k == batch.num_rows - 1:
                    halves = np.frombuffer(bytes(digests), ">i8").astype(np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(row, pa.int64())), pa.array(places, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                    ], ["doc", "unit", "h1", "h2"])
                    row, places, digests = [], [], bytearray()

    return run


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, unit: str = "clause") -> DataFrame:
    """``(doc, unit)``, the number in its document, of every unit that an earlier one equals."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("doc"), as_bytes(F.col(f"`{text_col}`")).alias("text"))
    found = rows.mapInArrow(_digests(unit), f"doc {kind}, unit int, h1 long, h2 long")
    # Both sides of the join are written: it then joins two plain shuffles, whose hot keys adaptive execution can split.
    found = written(found, "units")
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("doc", "unit")).alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = found.join(written(first.select("h1", "h2", "first"), "firsts", free=True), ["h1", "h2"])
    return joined.where((F.col("doc") != F.col("first.doc")) | (F.col("unit") != F.col("first.unit"))).select("doc", "unit")


def long_runs(found: list[tuple[int, int, bytes]], marked: set[int], min_words: int, text: bytes) -> list[tuple[int, int, int]]:
    """Runs of marked units with ``min_words`` words together: first byte, the one past the sign that ends them, units."""
    runs, begin = [], None
    for k in range(len(found) + 1):
        if k < len(found) and k in marked:
            begin = k if begin is None else begin
        elif begin is not None:
            if sum(key.count(b" ") + 1 for _, _, key in found[begin:k]) >= min_words:
                high = found[k - 1][1]
                runs.append((found[begin][0], high + 1 if text[high:high + 1] and text[high:high + 1] in ENDS else high, k - begin))
            begin = None
    return runs


def without(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without the rising ``spans``, and these in characters of the original."""
    kept, chars, at, char = [], [], 0, 0
    for low, high in spans:
        kept.append(text[at:low])
        start = char + len(text[at:low].decode("utf-8", "surrogateescape"))
        char = start + len(text[low:high].decode("utf-8", "surrogateescape"))
        chars.append((start, char))
        at = high
    return b"".join(kept) + text[at:], chars


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = MIN_WORDS, unit: str = "clause",
) -> DataFrame:
    """``(id_col, n_units, n_removed, removed, kept_text)`` of every row; ``removed`` are ``(start, end)`` characters of the original.

    ``n_removed`` counts units.  A unit without a word is none; null, empty and very short texts are unchanged (null as
    empty).  Ranks go by id, then place; a passage that repeats in its own document is removed too.  A document without an id is
    left alone and takes nothing from others.  Rows that repeat an id are one document: what is marked at a place is
    marked in each.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    # bounded by one document's own units
    marked = repeated_units(docs, id_col, text_col, unit=unit).groupBy("doc").agg(F.collect_set("unit").alias("marked"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), as_bytes(F.col(f"`{text_col}`")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, removed, kept = [], [], [], []
            for value, numbers in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = value.as_py()
                found = units(text, unit)
                runs = long_runs(found, set(numbers or ()), min_words, text)
                rest, chars = without(text, [r[:2] for r in runs])
                counts.append(len(found))
                gone.append(sum(r[2] for r in runs))
                removed.append([{"start": a, "end": b} for a, b in chars])
                kept.append(rest)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
            ], ["id", "n_units", "n_removed", "removed", "kept_text"])

    out = rows.join(marked, "doc", "left").select("doc", "text", "marked").mapInArrow(
        run, f"id {kind}, n_units long, n_removed long, removed array<struct<start:long,end:long>>, kept_text binary")
    return out.withColumn("kept_text", F.col("kept_text").cast("string")).withColumnRenamed("id", id_col)
