"""Toxicity by a support vector machine over a subsequence string kernel.

Two words are alike by the letter triples they share in the same order, each weighted down by the
letters it skips: an insult with letters inserted, dropped or spaced out keeps most of its
triples.  A Nyström map turns the kernel into a few coordinates: the likeness to landmark words, which
are drawn from the labelled rows, decorrelated by the landmarks' own kernel.  A text, a sentence or a
whole document alike, is described by the dampened sum over its words.

Learning takes a bounded sample of labelled rows (``per_class``); scoring covers every text whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import as_bytes, slices, written

TRIPLE = 3
REACH = 6      # letters that a triple may stretch over
DECAY = 0.7    # weight of each letter it stretches over
LONGEST = 24   # a longer word is read in overlapping pieces of this length
NEAR = 0.45    # likeness below which a word is not like a landmark at all
WIDTH = 0.15   # of the Gaussian over the distance between words
LANDMARKS = 160
PER_CLASS = 5_000
HELD = 50_000  # words of texts, repeats included, that a reader holds at once; one text is always held whole
_LETTERS = 32

# Single letters with one to three characters between them that are no letters; on ASCII both patterns say the same.
_SPACED = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[\W\d_]{1,3}[^\W\d_](?![^\W\d_])){3,}")
_SPACED_ASCII = re.compile(rb"(?<![a-z])[a-z](?:[^a-z]{1,3}[a-z](?![a-z])){3,}")
_NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
_ACCENT = re.compile("[\u0300-\u036f]")  # combining marks
_MARKS = bytes(b for b in range(128) if not chr(b).isalpha() and not chr(b).isspace() or 0x1C <= b < 0x20)
_SHAPES = [(0, i, j) for i, j in combinations(range(1, REACH), TRIPLE - 1)]
_SHAPE_WEIGHT = np.array([DECAY ** (j + 1) for _, _, j in _SHAPES], np.float32)


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words of a UTF-8 text without accents and ASCII marks; letters spaced out as one word besides."""
    plain = text.decode("utf-8", "replace").lower()
    if plain.isascii():
        flat = plain.encode()
        spaced = [m.group().translate(None, _NO_LETTERS) for m in _SPACED_ASCII.finditer(flat)]
    else:
        plain = _ACCENT.sub("", unicodedata.normalize("NFKD", plain))
        flat = plain.encode("utf-8", "replace")
        spaced = ["".join(c for c in m.group() if c.isalpha()).encode() for m in _SPACED.finditer(plain)]
    return [*flat.translate(None, _MARKS).split(), *spaced]


def _plain(word: bytes) -> str:
    """The letters of a word; only one that is not ASCII can hold anything else."""
    return word.decode("ascii") if word.isascii() else "".join(c for c in word.decode("utf-8", "replace") if c.isalpha())


def pieces(word: str) -> list[str]:
    half = LONGEST // 2
    return [word] if len(word) <= LONGEST else [word[k:k + LONGEST] for k in range(0, len(word) - half, half)]


def _codes(words: list[str]) -> tuple[np.ndarray, int]:
    """Letters as numbers from 1 to 31, a row per word, and the longest word's length; 0 fills up."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max(initial=1))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    codes = np.zeros((len(words), width + REACH), np.int32)
    codes[np.arange(width + REACH) < lengths[:, None]] = np.where((flat >= 97) & (flat <= 122), flat - 96, 27 + flat % 5)
    return codes, width


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, triple code and weight of the letter triples of words, by row; weights of a word have norm one."""
    codes, span = _codes(words)
    keys, weights = [], []
    first = codes[:, :span] * _LETTERS**2
    for (_, i, j), weight in zip(_SHAPES, _SHAPE_WEIGHT.tolist(), strict=True):
        c = codes[:, j:j + span]
        row, at = np.nonzero(c)
        key = (first + codes[:, i:i + span] * _LETTERS + c)[row, at]
        keys.append(row * _LETTERS**3 + key)
        weights.append(np.full(len(row), weight, np.float32))
    both, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(both)
    both, weight = both[order], weight[order]
    begins = np.flatnonzero(np.diff(both, prepend=-1))
    summed = np.add.reduceat(weight, begins) if len(begins) else weight
    row, key = both[begins] // _LETTERS**3, both[begins] % _LETTERS**3
    norm = np.sqrt(np.bincount(row, summed**2, len(words)))
    return row, key, (summed / norm[row]).astype(np.float32)


class Landmarks:
    """Likeness of words to a fixed list of words."""

    def __init__(self, words: list[str], groups: int = 16):
        self.words = words
        row, key, weight = triples(words)
        self.table = np.zeros((_LETTERS**3, len(words)), np.float32)
        self.table[key, row] = weight
        # groups of like landmarks: the greatest weight in a group bounds the likeness to each of its members
        like, leaders = self.table.T @ self.table, [0]
        while len(leaders) < min(groups, len(words)):
            leaders.append(int(np.argmin(like[:, leaders].max(axis=1))))
        group = np.argmax(like[:, leaders], axis=1)
        self.bounds = np.stack([self.table[:, group == g].max(axis=1) for g in range(len(leaders)) if (group == g).any()], axis=1)

    def likeness(self, words: list[str], least: float = 0.0) -> np.ndarray:
        """Kernel of each word with each landmark, 0 to 1; a word like none over ``least`` may get zeros.

        Words under three letters are like nothing.
        """
        found = np.zeros((len(words), len(self.words)), np.float32)
        for low in range(0, len(words), 2048):
            row, key, weight = triples(words[low:low + 2048])
            if not len(row):
                continue
            if least > 0:
                begins = np.flatnonzero(np.diff(row, prepend=-1))
                bound = np.zeros(row[-1] + 1, np.float32)
                bound[row[begins]] = np.add.reduceat(self.bounds[key] * weight[:, None], begins, axis=0).max(axis=1)
                use = bound[row] > least
                row, key, weight = row[use], key[use], weight[use]
            begins = np.flatnonzero(np.diff(row, prepend=-1))
            if len(begins):
                found[low + row[begins]] = np.add.reduceat(self.table[key] * weight[:, None], begins, axis=0)
        return found


def _near(kernel: np.ndarray) -> np.ndarray:
    """A Gaussian over the distance in the string kernel's space; zero below ``NEAR``."""
    return np.where(kernel > NEAR, np.exp((kernel - 1) / WIDTH), 0).astype(np.float32)


class Reader:
    """Describes texts by their words' likeness to the landmarks; remembers words, and forgets all at ``most``."""

    def __init__(self, landmarks: Landmarks, most: int = 400_000):
        self.landmarks, self.most = landmarks, most
        self.seen: set[bytes] = set()
        self.near: dict[bytes, np.ndarray] = {}

    def learn(self, unseen: set[bytes]) -> None:
        new = [(w, p) for w in unseen for p in pieces(_plain(w)) if len(p) >= TRIPLE]
        for low in range(0, len(new), 2048):
            part = new[low:low + 2048]
            like = self.landmarks.likeness([p for _, p in part], NEAR)
            for n in np.flatnonzero(like.max(axis=1) > NEAR).tolist():
                word = part[n][0]
                self.near[word] = np.maximum(self.near[word], _near(like[n])) if word in self.near else _near(like[n])
        self.seen |= unseen

    def describe(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """For each text the dampened sum of its words' likeness to each landmark, and of all likeness at the end.

        The sum over a text's words is the convolution kernel between the text and a landmark.  Letters
        spaced out are read as one word too.
        """
        width, low = len(self.landmarks.words), 0
        while low < len(texts):  # so many texts at a time that their words fit the memory
            if len(self.seen) > self.most:
                self.seen, self.near = set(), {}
            unseen, read, held = set(), [], 0
            while low < len(texts) and held < HELD:
                words = words_of(texts[low])
                distinct = set(words)
                unseen |= distinct - self.seen
                read.append((words, distinct))
                held += len(words)
                low += 1
            self.learn(unseen)
            for words, distinct in read:
                total = np.zeros(width, np.float32)
                if hits := distinct & self.near.keys():
                    for word in words:
                        if word in hits:
                            total += self.near[word]
                yield np.append(np.log1p(total), np.log1p(total.sum()))


@dataclass
class Model:
    """Landmark words, the machine's weights on their likeness, and the calibration of its margin."""

    words: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, reader: Reader, texts: list[bytes]) -> np.ndarray:
        return np.fromiter((float(d @ self.weights) + self.bias for d in reader.describe(texts)), np.float64, len(texts))

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))

    def score(self, text: Column) -> Column:
        """Score of a text column, 0 to 1; null and empty texts get the score of a text without any such word."""
        model = self

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            reader = Reader(Landmarks(model.words))
            for texts in batches:
                yield pd.Series(model.probability(model.margins(reader, [bytes(t) for t in texts])), dtype="float64")

        return scored(as_bytes(text))


def held_out(id_col: Column) -> Column:
    """Rows that never teach: crc32 of the id as text is a multiple of five; a row without an id is one of them."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps on the rows inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        inside = y * (x @ w) < 1
        a = x[inside] * weight[inside, None]
        new = np.linalg.solve(a.T @ x[inside] + np.diag(penalty), a.T @ y[inside])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], float(w[-1])


def _calibrated(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, with smoothed labels."""
    up, down = weight[y > 0].sum(), weight[y <= 0].sum()
    goal = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (p - goal)) + 1e-3 * (at - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(at[0]), 1e-3), float(at[1])


def _sample(labels: DataFrame, id_col: str, label_col: str, per_class: int) -> DataFrame:
    """At most ``per_class`` teaching rows of each label, those with the least hash; an id counts once, as toxic if any label says so."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("labelled")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    of = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("labelled"), "labelled").limit(per_class) for k in (0, 1)]
    return of[0].unionByName(of[1])


def _pick(candidates: list[str], most: int) -> list[str]:
    """The first words, none very like one taken before."""
    taken: list[str] = []
    table = np.zeros((_LETTERS**3, most), np.float32)
    row, key, weight = triples(candidates)
    edges = np.searchsorted(row, np.arange(len(candidates) + 1))
    for n, word in enumerate(candidates):
        own = slice(edges[n], edges[n + 1])
        if len(taken) < most and (weight[own] @ table[key[own], :max(len(taken), 1)]).max() < 0.85:
            table[key[own], len(taken)] = weight[own]
            taken.append(word)
    return taken


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *,
    landmarks: int = LANDMARKS, per_class: int = PER_CLASS, candidates: int = 1_500,
) -> Model:
    """A model from at most ``per_class`` labelled rows of each label; without toxic or clean rows it finds nothing toxic.

    Ids, languages and sources are never read as inputs.  Landmarks are words that toxic rows hold far more often than
    clean ones.
    """
    # at most 2 * per_class ids: a proven bound
    sample = written(_sample(labels, id_col, label_col, per_class), "labels")
    rows = docs.join(F.broadcast(sample), F.col(f"`{id_col}`") == sample["labelled"]).select(
        "labelled", "toxic", as_bytes(F.col(f"`{text_col}`")).alias("text"))
    rows = written(rows, "labelled_texts")
    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nothing = Model(["nothing"], np.zeros(2), -1.0, 1.0, -3.0)
    if not totals.get(0) or not totals.get(1):
        return nothing

    def taught_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, toxic = [], []
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = {p for w in set(words_of(text.as_py())) for p in pieces(_plain(w)) if len(p) >= TRIPLE}
                words += own
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])

    counts = rows.select("text", "toxic").mapInArrow(taught_words, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("up"), F.sum(1 - F.col("toxic")).alias("down"))
    lift = F.col("up") / totals[1] - 3 * F.col("down") / totals[0]
    top = counts.where("up >= 2").select("word", lift.alias("lift")).where("lift > 0").orderBy(F.desc("lift"), "word").limit(candidates).collect()
    chosen = _pick([r.word for r in top], landmarks)
    if not chosen:
        return nothing

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Landmarks(chosen))
        for batch in slices(batches):
            found = [d.tolist() for d in reader.describe([t.as_py() for t in batch.column(0)])]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.float32()))], ["toxic", "labelled", "x"])

    kind = sample.schema["labelled"].dataType.simpleString()
    taught = rows.select("text", "toxic", "labelled").mapInArrow(described, f"toxic int, labelled {kind}, x array<float>")
    # bounded: 2 * per_class rows of len(chosen) numbers
    got = taught.orderBy(F.xxhash64("labelled"), "labelled").select("toxic", "x").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1).astype(np.float64)
    y = np.where(got["toxic"].to_numpy() > 0, 1.0, -1.0)
    values, vectors = np.linalg.eigh(_near(Landmarks(chosen).likeness(chosen)).astype(np.float64))
    nystroem = np.eye(len(chosen) + 1)
    nystroem[:-1, :-1] = vectors / np.sqrt(np.maximum(values, 1e-2)) @ vectors.T
    z = x @ nystroem
    # the sample holds more toxic rows than the corpus: weights restore the labels' own shares
    open_labels = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(f"`{id_col}`")))
    whole = {r.toxic: r.n for r in open_labels.groupBy((F.col(label_col) > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    share = np.where(y > 0, whole[1] / (y > 0).sum(), whole[0] / (y < 0).sum())
    share = share / share.mean()
    fold = np.arange(len(y)) % 5 == 0
    if len(set(y[fold])) < 2 or len(set(y[~fold])) < 2:
        fold[:] = False
    w, bias = _machine(z[~fold], y[~fold], share[~fold])
    margins = z @ w + bias
    use = fold if fold.any() else ~fold
    slope, offset = _calibrated(margins[use], y[use], share[use])
    return Model(chosen, nystroem @ w, bias, slope, offset)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(id_col, held_out, score, predicted)`` of every row; repeated rows get equal scores, an empty table gives an empty one."""
    model = train(docs, labels, id_col, text_col, **options)
    ident = F.col(f"`{id_col}`")
    out = docs.select(ident.alias(id_col), held_out(ident).alias("held_out"), model.score(F.col(f"`{text_col}`")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all columns; a narrow step after learning."""
    model = train(docs, labels, id_col, text_col, **options)
    return docs.where(model.score(F.col(f"`{text_col}`")) < 0.5)
