"""Document quality by co-training.

Two classifiers see different sides of a document: one its text, one its metadata and layout.  Both begin
with the labelled rows.  In each round every view scores all documents, and those it is sure of teach
the other view.  At the end the two calibrated views are combined and score all documents.

Both are additive over discrete features (naive Bayes log ratios), so a round of learning is one pass that sums
counts by feature.  Their number is fixed by the hash sizes, whatever the corpus, and it is all
that reaches the driver.  Calibration uses labelled rows that teach nothing, as counts of labels by margin.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import as_bytes, written

WORDS = 1 << 14    # hashed words
STATS = 16         # bins of each statistic of the text
META = 1 << 10     # hashed metadata values
SURE = 0.98
ROUNDS = 3
_BIN = 0.25        # width of the margins' bins
_BINS = 400
_SYMBOLS = set(b"#*$%&|<>!?{}[]=_~^")


def _bin(value: float) -> int:
    return min(STATS - 1, int(max(value, 0.0) * STATS))


def text_features(text: bytes) -> tuple[list[int], list[int]]:
    """Hashed distinct words, and binned statistics of the text itself."""
    words = text.lower().split()
    distinct = set(words)
    n = max(len(words), 1)
    letters = sum(map(len, words)) or 1
    symbols = letters - len(b"".join(words).translate(None, bytes(_SYMBOLS)))
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    lines = [line for line in text.split(b"\n") if line.strip()]
    stats = [
        _bin(len(distinct) / n), _bin(letters / n / 16), _bin(symbols / letters * 2), _bin(upper / letters), _bin(digits / letters * 2),
        _bin(1 - len(set(lines)) / max(len(lines), 1)), _bin(math.log2(n + 1) / 16),
    ]
    return sorted({zlib.crc32(w) % WORDS for w in distinct}), [WORDS + k * STATS + b for k, b in enumerate(stats)]


N_TEXT = WORDS + 7 * STATS


def meta_features(text: bytes, values: list) -> list[int]:
    """Hashed metadata values, and the size of the text and of its lines."""
    n_lines = text.count(b"\n") + 1
    layout = [f"bytes {int(math.log2(len(text) + 1) * 2)}", f"lines {int(math.log2(n_lines))}", f"line {int(math.log2(len(text) / n_lines + 1))}"]
    return [zlib.crc32(f"{k}={v}".encode()) % META for k, v in enumerate([*values, *layout])]


def features(docs: DataFrame, id_col: str, text_col: str, meta_cols: list[str]) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, stats, meta = [], [], []
            for text, values in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = text.as_py()
                a, b = text_features(text)
                words.append(packed(a))
                stats.append(b)
                meta.append(meta_features(text, values))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), pa.array(stats, ints), pa.array(meta, ints)], ["id", "words", "stats", "meta"])

    values = F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in meta_cols]).cast("array<string>")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), as_bytes(F.col(f"`{text_col}`")).alias("text"), values.alias("values"))
    return rows.mapInArrow(run, f"id {kind}, words binary, stats array<int>, meta array<int>")


@dataclass
class View:
    """Log ratios of a view's features, and the calibration of its margin."""

    ratios: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def packed(ids: list[int]) -> bytes:
    """Rising numbers as compressed steps: what travels and is stored of a text is about a byte a word."""
    return zlib.compress(np.diff(np.array(ids, np.uint16), prepend=np.uint16(0)).tobytes(), 1)


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All rows' features one behind the other, and where each row begins and ends."""
    column = batch.column(batch.schema.get_field_index(name))
    if name != "words":
        offsets = column.offsets.to_numpy()
        return column.values.to_numpy()[offsets[0]:offsets[-1]], offsets - offsets[0]
    steps = [zlib.decompress(x) for x in column.to_pylist()]
    offsets = np.cumsum([0, *(len(x) // 2 for x in steps)])
    total = np.cumsum(np.frombuffer(b"".join(steps), np.uint16), dtype=np.int64)
    before = np.concatenate([[0], total])[offsets[:-1]]
    return total - np.repeat(before, np.diff(offsets)), offsets


def _sums(batch: pa.RecordBatch, name: str, ratios: np.ndarray) -> np.ndarray:
    """Sum of the ratios of each row's features; words count by the root of their number, so that long texts are not surer than they should be."""
    values, offsets = _lists(batch, name)
    lengths = np.diff(offsets)
    sums = np.zeros(len(lengths))
    if lengths.any():
        # row by row, so that a row's sum does not depend on the rows around it
        sums[lengths > 0] = np.add.reduceat(ratios[values], offsets[:-1][lengths > 0])
    return sums / np.maximum(lengths, 1) ** 0.5 if name == "words" else sums


def margins(batch: pa.RecordBatch, text: View, meta: View) -> tuple[np.ndarray, np.ndarray]:
    return _sums(batch, "words", text.ratios) + _sums(batch, "stats", text.ratios), _sums(batch, "meta", meta.ratios)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic curve through weighted rows, the last for the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    start = np.append(np.ones(x.shape[1] - 1), 0.0)
    at = start.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 0.1 * (at - start)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(at))
        step = np.clip(np.linalg.solve(curve, slope), -2, 2)
        at = at - step
        if np.abs(step).max() < 1e-9:
            break
    return at


def _calibrated(rows: DataFrame, text: View, meta: View) -> tuple[View, View, np.ndarray]:
    """Both views calibrated, and the combination, on labelled rows outside the teaching part, counted by margins' bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.clip(np.round(m / _BIN), -_BINS, _BINS).astype(np.int64) for m in margins(batch, text, meta))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), batch.column(batch.schema.get_field_index("label"))], ["a", "b", "label"])

    counted = rows.where("label IS NOT NULL AND NOT teaches").mapInArrow(run, "a long, b long, label int").groupBy("a", "b", "label").count().collect()
    if len({r.label for r in counted}) < 2:
        return text, meta, np.array([1.0, 1.0, 0.0])
    x = np.array([(r.a, r.b) for r in counted], float) * _BIN
    y, n = np.array([r.label for r in counted], float), np.array([r["count"] for r in counted], float)
    for k, view in enumerate((text, meta)):
        view.slope, view.offset = _logistic(x[:, [k]], y, n)
    sides = np.stack([v.slope * x[:, k] + v.offset for k, v in enumerate((text, meta))], axis=1)
    return text, meta, _logistic(sides, y, n)


def _taught(rows: DataFrame, views: tuple[View, View] | None, sure: float, weight: float) -> tuple[View, View]:
    """Views from the teaching rows and, given earlier views, from what each is sure of about the other's unlabelled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, N_TEXT)), np.zeros((2, META))]
        sizes = np.zeros((2, 2))
        for batch in batches:
            label = batch.column(batch.schema.get_field_index("label")).fill_null(-1).to_numpy()
            teaches = batch.column(batch.schema.get_field_index("teaches")).to_numpy(zero_copy_only=False).astype(bool)
            said = np.full((2, len(label)), -1)
            if views is not None:
                for k, margin in enumerate(margins(batch, *views)):
                    p = views[k].probability(margin)
                    said[1 - k] = np.where(p >= sure, 1, np.where(p <= 1 - sure, 0, -1))
            for k, names in enumerate((("words", "stats"), ("meta",))):
                for y in (0, 1):
                    use = np.where((label == y) & teaches, 1.0, np.where((label == -1) & (said[k] == y), weight, 0.0))
                    sizes[k, y] += use.sum()
                    for name in names:
                        values, offsets = _lists(batch, name)
                        sums[k][y] += np.bincount(values, np.repeat(use, np.diff(offsets)), sums[k].shape[1])
        for k in (0, 1):
            found = np.flatnonzero(sums[k].any(axis=0))
            ids = np.append(found, -1)
            both = np.concatenate([sums[k][:, found], sizes[k][:, None]], axis=1)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(ids), k), pa.int32()), pa.array(ids, pa.int32()), pa.array(both[0]), pa.array(both[1])], ["view", "f", "bad", "good"])

    # at most one row a feature
    got = rows.mapInArrow(run, "view int, f int, bad double, good double").groupBy("view", "f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
    out = []
    for k, size in enumerate((N_TEXT, META)):
        counts, totals = np.zeros((2, size)), np.zeros(2)
        for r in got:
            if r.view == k and r.f >= 0:
                counts[:, r.f] = r.bad, r.good
            elif r.view == k:
                totals[:] = r.bad, r.good
        ratios = np.log((counts[1] + 1) / (totals[1] + 2)) - np.log((counts[0] + 1) / (totals[0] + 2))
        ratios[counts.sum(axis=0) == 0] = 0.0
        out.append(View(ratios))
    return out[0], out[1]


def co_trained(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    meta_cols: tuple[str, ...] = ("lang", "source"), *, rounds: int = ROUNDS, sure: float = SURE, weight: float = 0.5,
) -> DataFrame:
    """``(id_col, p_text, p_meta, score, kept)`` of every row; ``kept`` where ``score`` is at least a half.

    All labelled and all unlabelled rows take part in each round.  An id labelled more than once counts as its worst
    label; null labels teach nothing, and without labels of both kinds every row is kept.  A row without an id is
    unlabelled.  Null texts and metadata count as empty.  Rows are scored one by one, so repeated rows get equal scores.
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_labelled")).agg(F.min((F.col(label_col) > 0).cast("int")).alias("label"))
    rows = features(docs, id_col, text_col, [c for c in meta_cols if c in docs.columns])
    rows = rows.join(known, rows["id"] == known["_labelled"], "left").drop("_labelled")
    teaches = F.coalesce(F.pmod(F.xxhash64("id"), F.lit(5)) != 0, F.lit(False))
    rows = written(rows.withColumn("teaches", teaches), "views")
    kinds = {r.label for r in rows.where("label IS NOT NULL AND teaches").select("label").distinct().collect()}
    views, both = None, np.array([0.0, 0.0, 5.0])
    if len(kinds) == 2:
        for _ in range(rounds + 1):
            text, meta = _taught(rows, views, sure, weight)
            text, meta, both = _calibrated(rows, text, meta)
            views = (text, meta)
    views = views or (View(np.zeros(N_TEXT)), View(np.zeros(META)))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = margins(batch, *views)
            sides = [v.slope * m + v.offset for v, m in zip(views, (a, b), strict=True)]
            score = 1 / (1 + np.exp(-np.clip(both[0] * sides[0] + both[1] * sides[1] + both[2], -30, 30)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(views[0].probability(a)), pa.array(views[1].probability(b)), pa.array(score)], ["id", "p_text", "p_meta", "score"])

    out = rows.select("id", "words", "stats", "meta").mapInArrow(run, f"id {kind}, p_text double, p_meta double, score double")
    return out.withColumn("kept", F.col("score") >= 0.5).withColumnRenamed("id", id_col)
