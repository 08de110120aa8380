"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of all benchmark items, ``window`` words each, are the patterns of one
automaton over normalised text.  Each document is scanned once; a match marks the words
of its window, and the runs of marked words are mapped back to characters of the original.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import as_bytes

WINDOW = 10
# The most pattern text one automaton holds: it is built in every Python worker.
MOST_BYTES = 64 << 20

# Bytes that are letters, digits or part of a non-ASCII character stay (A-Z lower-cased); all others separate words.
_KEPT = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_NORMAL = bytearray(b" " * 256)
for _byte in _KEPT:
    _NORMAL[_byte] = _byte
for _byte in range(0x41, 0x5B):
    _NORMAL[_byte] = _byte + 32
_NORMAL = bytes(_NORMAL)


def normal_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text; one byte becomes one byte, so places in the original are kept."""
    return text.translate(_NORMAL).split()


def windows(words: list[bytes], window: int = WINDOW) -> set[bytes]:
    """All windows of an item, space-joined; a shorter item is one window, one without words none."""
    if not words:
        return set()
    return {b" ".join(words[k:k + window]) for k in range(max(1, len(words) - window + 1))}


class Patterns:
    """Distinct windows with the items that hold them, and the automaton over them, built once in each worker."""

    def __init__(self, items: dict[bytes, list[str]]):
        self.items = items
        self._automaton = None

    def __getstate__(self):
        return self.items

    def __setstate__(self, items):
        self.__init__(items)

    @property
    def automaton(self):
        if self._automaton is None:
            made = ahocorasick.Automaton()
            for pattern, ids in self.items.items():
                # a space on both sides: matches begin and end with whole words
                made.add_word(f" {pattern.decode('utf-8', 'surrogateescape')} ", (pattern.count(b" ") + 1, ids))
            if len(made):
                made.make_automaton()
            self._automaton = made
        return self._automaton


def patterns(items: DataFrame, id_col: str, text_col: str, window: int, most_bytes: int) -> list[Patterns]:
    """The items' windows in automata of at most ``most_bytes`` of text; nearly always one.

    A larger benchmark is dealt into several automata that are applied one after the other, so the
    size of what a worker holds at a time is bounded and no item is left out.
    """
    parts: list[Patterns] = []
    held: dict[bytes, list[str]] = {}
    size = 0
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("id"), as_bytes(F.col(f"`{text_col}`")).alias("text"))
    for row in rows.toLocalIterator():
        for found in windows(normal_words(bytes(row.text)), window):
            ids = held.setdefault(found, [])
            if row.id is not None and row.id not in ids:
                ids.append(row.id)
            size += len(found) + 16
        if size > most_bytes:
            parts.append(Patterns(held))
            held, size = {}, 0
    return [*parts, Patterns(held)]


def scan(text: bytes, parts: list[Patterns]) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """Words, hit words, sorted ids of the items that occur, and hit runs as (first, past the last) character."""
    flat = text.translate(_NORMAL)
    words = flat.split()
    line = f" {b' '.join(words).decode('utf-8', 'surrogateescape')} "
    ends: list[tuple[int, int]] = []
    ids: set[str] = set()
    for part in parts:
        if len(part.automaton):
            for end, (n, found) in part.automaton.iter(line):
                ends.append((end, n))
                ids.update(found)
    if not ends:
        return len(words), 0, [], []
    # the closing space of the k-th word stands where the k first words and their spaces end
    closing = np.fromiter(accumulate((len(w.decode("utf-8", "surrogateescape")) + 1 for w in words)), np.int64, len(words))
    edge = np.zeros(len(words) + 1, np.int64)
    for (_, n), last in zip(ends, np.searchsorted(closing, [e for e, _ in ends]).tolist(), strict=True):
        edge[last + 1 - n] += 1
        edge[last + 1] -= 1
    hit = np.cumsum(edge[:-1]) > 0
    step = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    starts, at = [], 0
    for w in words:
        at = flat.index(w, at)
        starts.append(at)
        at += len(w)
    spans, char, byte = [], 0, 0
    for first, past in zip(step[::2].tolist(), step[1::2].tolist(), strict=True):
        low, high = starts[first], starts[past - 1] + len(words[past - 1])
        start = char + len(text[byte:low].decode("utf-8", "surrogateescape"))
        char = start + len(text[low:high].decode("utf-8", "surrogateescape"))
        byte = high
        spans.append((start, char))
    return len(words), int(hit.sum()), sorted(ids), spans


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", *, window: int = WINDOW, most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit``, ``item_ids`` and ``spans`` of hit characters ``(start, end)``.

    A null or empty text has no words and is clean; an empty benchmark leaves all clean.  Items with
    the same window are all reported, an item without an id only by its hits.  Rows are independent,
    so repeated rows get equal results.  Only the id and the text of ``docs`` are returned besides.
    """
    parts = docs.sparkSession.sparkContext.broadcast(patterns(items, item_id, item_text, window, most_bytes))
    kind = docs.schema[id_col].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py(), parts.value) for t in batch.column(1)]
            words, hits, ids, spans = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array(ids, pa.list_(pa.string())),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], spans_type),
            ], ["id", "n_words", "n_hit", "item_ids", "spans"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), as_bytes(F.col(f"`{text_col}`")).alias("text"))
    return rows.mapInArrow(
        run, f"id {kind}, n_words long, n_hit long, item_ids array<string>, spans array<struct<start:long,end:long>>"
    ).withColumnRenamed("id", id_col)


def clean_rows(docs: DataFrame, items: DataFrame, text_col: str = "text", *, window: int = WINDOW, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of ``docs`` without a window of any item, all columns kept; a narrow step, no shuffle."""
    parts = docs.sparkSession.sparkContext.broadcast(patterns(items, "item_id", "text", window, most_bytes))

    @F.pandas_udf("boolean")
    def clean(texts):
        return texts.map(lambda t: scan(bytes(t), parts.value)[1] == 0)

    return docs.where(clean(as_bytes(F.col(f"`{text_col}`"))))
