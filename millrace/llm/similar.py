"""Pairs of texts by the exact Jaccard similarity of their word shingles, without a lossy sketch.

*Candidates.*  With the shingles of every text in one common order, two texts of at least
``similarity`` share a shingle among their first ``n - ceil(similarity * n) + 1``.  Any order is right;
this one puts shingles of well-filled counters last, so that passages many texts hold are rarely among the first.

*Links.*  The links of the SimHash fingerprints come first, each verified.  Then neighbours under a shared shingle that those
did not link are verified, so that a group of near copies becomes one set by links in proportion to its rows.  Then all pairs under a shared shingle that are still in
different sets are looked at, and those that their sketches do not rule out are verified.  A pair is told under the first shingle it
shares, as far as the earlier shingles its rows carry show it.  The rows of a crowded shingle
are dealt into blocks, so a task holds a bounded number of them.  Verification counts the common shingles of the texts themselves.

*Sketches.*  A bit tells whether an odd number of a set's hashes fall into its bucket.  The bits in which two sketches differ are at most
the hashes in which the sets differ, and nearly as many, so they bound the common ones from above and lose no pair.

Only components are kept: two texts are in one set exactly when a chain of similar pairs joins them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shared import as_bytes, remove, slices, written

SEED = 42
# Counters of the common order: it decides the work, never the result.
COUNTERS = 1 << 17
# Pairs that a task verifies at once, with the texts they need.
CHUNK = 2_000
# Bits of the shortest sketch, by which pairs are ruled out where they meet.
LEAST_BITS = 1024
# Rows of one shingle that meet in a task are at most about two times so many.
CROWD = 500
# Earlier shingles of a set that a row carries, to tell pairs that have met before.
EARLIER = 8


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 hashes of the word shingles of a UTF-8 text in order, repeats included; a shorter text is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, span = memoryview(b" ".join(words)), min(shingle, len(words))
    ends = [0, *accumulate(len(w) + 1 for w in words)]
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    return np.fromiter((digest(joined[ends[k]:ends[k + span] - 1], SEED) for k in range(n)), np.uint64, n)


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Different hashes of the word shingles, rising."""
    return np.unique(shingle_hashes(text, shingle))


def majority(hashes: np.ndarray, chunk: int = 1 << 15) -> int:
    """SimHash fingerprint of shingle hashes, as a signed long: a bit is set if over half of them have it; 0 for none."""
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), chunk):
        ones += np.unpackbits(hashes[low:low + chunk].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def set_key(hashes: np.ndarray) -> int:
    """Name of a shingle set, as a signed long."""
    key = xxhash.xxh64_intdigest(hashes.tobytes(), SEED)
    return key - (1 << 64) if key >> 63 else key


def least_common(n, similarity: float):
    """Fewest shingles that two sets of ``n`` together have in common when they are similar enough."""
    return np.ceil(np.asarray(n) * similarity / (1 + similarity) - 1e-9).astype(np.int64)


def first_shingles(n: int, similarity: float) -> int:
    """So many of ``n`` ordered shingles suffice to meet every similar set."""
    return n - int(np.ceil(n * similarity - 1e-9)) + 1


def sketch_of(hashes: np.ndarray) -> bytes:
    """A bit a bucket, set where an odd number of hashes fall; at least two buckets a hash."""
    m = max(LEAST_BITS, 1 << int(2 * len(hashes)).bit_length())
    odd = np.bincount((hashes % m).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of the same hashes with ``size`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), axis=0)


def most_common(one: bytes, two: bytes, n: int) -> int:
    """Upper bound of the common hashes of two sets of ``n`` together, by their sketches."""
    size = min(len(one), len(two))
    return int(n - np.bitwise_count(folded(one, size) ^ folded(two, size)).sum()) // 2


def set_prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, mark, fp, n, sketch, bits)`` per row: a hash of the whole text, the name of its shingle set, its size, sketch and SimHash."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            every = [shingle_hashes(t.as_py(), shingle) for t in batch.column(2)]
            sets = [np.unique(x) for x in every]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(map(set_key, sets), pa.int64()), pa.array(map(len, sets), pa.int32()),
                pa.array(map(sketch_of, sets), pa.binary()), pa.array(map(majority, every), pa.int64())], ["id", "mark", "fp", "n", "sketch", "bits"])

    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("mark"), as_bytes(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, mark long, fp long, n int, sketch binary, bits long")


def _levels(texts: DataFrame, shingle: int) -> np.ndarray:
    """Level of each counter: eighths of a doubling over the median; one row a counter reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                np.add.at(held, (shingle_set(t.as_py(), shingle) % COUNTERS).astype(np.int64), 1)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["at", "n"])

    counts = np.zeros(COUNTERS)
    got = texts.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts[got["at"].to_numpy()] = got["n"].to_numpy()
    return np.floor(8 * np.log2(np.maximum(counts / max(np.median(counts), 1.0), 1.0))).astype(np.uint8)


def _shared(texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``(token, fp, n, at)``: the first shingles of every set that another set has among its own."""
    levels = texts.sparkSession.sparkContext.broadcast(_levels(texts, shingle))

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies in a task say nothing new; forgotten at a fixed number
        for batch in slices(batches):
            out: list[list[np.ndarray]] = [[], [], [], []]
            for t in batch.column(0):
                hashes = shingle_set(t.as_py(), shingle)
                key = set_key(hashes)
                if not (n := len(hashes)) or key in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(key)
                many = first_shingles(n, similarity)
                order = np.lexsort((hashes, levels.value[(hashes % COUNTERS).astype(np.int64)]))[:many]
                for held, values in zip(out, (hashes[order].view(np.int64), np.full(many, key), np.full(many, n), np.arange(many)), strict=True):
                    held.append(values.astype(np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["token", "fp", "n", "at"])

    rows = texts.select("text").mapInArrow(firsts, "token long, fp long, n long, at long")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose neighbour in order has the token too; a set is there once."""
        last: np.ndarray | None = None
        told = False
        for batch in batches:
            now = np.stack([batch.column(k).to_numpy() for k in range(4)])
            fresh = 0 if last is None else 1
            rows = now if last is None else np.concatenate([last[:, None], now], axis=1)
            again = np.concatenate([[False], (rows[0, 1:] == rows[0, :-1]) & (rows[1, 1:] == rows[1, :-1])])
            again[0] = False
            rows = rows[:, ~again]
            same = rows[0, 1:] == rows[0, :-1]
            keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            if fresh and told:
                keep[0] = False
            # the last row may meet one of the next batch
            told = bool(keep[-1]) or (fresh and len(keep) == 1 and told)
            last = rows[:, -1]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows[:, keep]], ["token", "fp", "n", "at"])

    return rows.repartition("token").sortWithinPartitions("token", "n", "fp").mapInArrow(met, "token long, fp long, n long, at long")


def _briefs(named: DataFrame) -> DataFrame:
    """``(fp, brief)``: the sketches folded to the shortest size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            short = [folded(x, LEAST_BITS // 8).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.binary())], ["fp", "brief"])

    return named.select("fp", "sketch").mapInArrow(run, "fp long, brief binary")


def _blocks(rows: DataFrame, crowd: int) -> DataFrame:
    """Rows (token, fp, n, at, root, brief, earlier, held) with ``token`` made a block of it and ``side``.

    ``held`` rows of a token beyond ``crowd`` are dealt into parts, and every two parts meet in one block: rows of side 0 with
    those of side 1.  Side -1 is one part with itself.  Two blocks with the same hash only make more pairs to look at.
    """
    parts = F.ceil(F.col("held") / crowd)
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("fp"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).cast("long")
    block = F.when(F.col("held") <= crowd, F.col("token")).otherwise(F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")))
    return dealt.select(block.alias("token"), "fp", "n", "at", "root", side.alias("side"), "brief", "earlier")


def _pairs(similarity: float, most_steps: int | None):
    """Pairs within runs of equal token, rows (token, fp, n, at, root, side, brief, earlier) in order of token and n.

    ``most_steps`` next rows only.  Rows without side, brief and earlier make pairs wherever they meet.  With them a pair counts
    under the first shingle it shares, where no common one stands before the two places, and is passed over where the earlier
    shingles show another.
    """

    def fits(rows: np.ndarray, told: tuple[np.ndarray, np.ndarray] | None, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        both = rows[2, x] + rows[2, y]
        least = least_common(both, similarity)
        reach = np.minimum(rows[2, x] - rows[3, x], rows[2, y] - rows[3, y])
        if told is None:
            return (rows[4, x] != rows[4, y]) & (reach + np.minimum(rows[3, x], rows[3, y]) >= least)
        briefs, earlier = told
        fit = (rows[4, x] != rows[4, y]) & (reach >= least) & ((rows[5, x] < 0) | (rows[5, x] != rows[5, y]))
        at = np.flatnonzero(fit)
        apart = np.bitwise_count(briefs[x[at]] ^ briefs[y[at]]).sum(axis=1, dtype=np.int64)
        fit[at] = (both[at] - apart) // 2 >= least[at]
        at = np.flatnonzero(fit)
        fit[at] = ~(earlier[x[at]][:, :, None] == earlier[y[at]][:, None, :]).any(axis=(1, 2))
        return fit

    def of(rows: np.ndarray, told: tuple[np.ndarray, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        at, step = np.arange(rows.shape[1]), 0
        while len(at) and (most_steps is None or step < most_steps):
            step += 1
            at = at[at + step < rows.shape[1]]
            # sizes rise within a run: what is too large stays so
            at = at[(rows[0, at] == rows[0, at + step]) & (rows[2, at] >= np.floor(rows[2, at + step] * similarity - 1e-9))]
            use = at[fits(rows, told, at, at + step)]
            if len(use):
                a, b = rows[1, use], rows[1, use + step]
                both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        told: tuple[np.ndarray, ...] | None = None
        for batch in batches:
            more = "brief" in batch.schema.names
            rows = np.stack([batch.column(k).to_numpy() for k in range(5 + more)])
            fresh = None
            if more:
                fresh = (
                    np.frombuffer(b"".join(batch.column("brief").to_pylist()), np.uint64).reshape(-1, LEAST_BITS // 64),
                    batch.column("earlier").flatten().to_numpy().reshape(-1, EARLIER))
            if held is not None:
                rows = np.concatenate([held, rows], axis=1)
                fresh = tuple(np.concatenate(two) for two in zip(told, fresh, strict=True)) if more else None
            cut = int(np.searchsorted(rows[0], rows[0, -1])) if rows.shape[1] else 0  # the last run may go on
            yield from of(rows[:, :cut], tuple(x[:cut] for x in fresh) if more else None)
            held, told = rows[:, cut:], tuple(x[cut:] for x in fresh) if more else None
        if held is not None:
            yield from of(held, told)

    return run


def _possible(pairs: DataFrame, named: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sketches do not rule them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            both = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            keep = [
                most_common(x, y, n) >= m
                for x, y, n, m in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), both.tolist(), least_common(both, similarity).tolist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = (named.select(F.col("fp").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}")) for k in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, rows: DataFrame, named: DataFrame, shingle: int, similarity: float, name: str) -> DataFrame:
    """The pairs that are similar, by their common shingles, written.

    Sketches, two to four bits a shingle, rule most pairs out first.  ``CHUNK`` of the others are a task's share; it
    gets each of their texts once.
    """
    pairs = written(pairs.distinct(), "pairs", free=True)
    ordered = _possible(pairs, named, similarity).repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    ordered = written(ordered.withColumn("row", F.monotonically_increasing_id()), "possible", free=True)
    remove(pairs)
    # the high bits are the partition's
    chunked = ordered.select("a", "b", F.floor(F.col("row") / CHUNK).alias("chunk"))
    need = chunked.select(F.col("chunk").alias("part"), F.explode(F.array("a", "b")).alias("fp")).distinct()
    wanted = need.join(named.select("fp", "mark"), "fp")
    shipped = rows.join(wanted, "mark").groupBy("part", "fp").agg(F.first("text").alias("text"))

    def count(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        sets = {fp: shingle_set(t.as_py(), shingle) for fp, t in zip(texts.column("fp").to_pylist(), texts.column("text"), strict=True)}
        a, b = pairs.column("a").to_pylist(), pairs.column("b").to_pylist()
        common = [len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)]
        least = [int(least_common(len(sets[x]) + len(sets[y]), similarity)) for x, y in zip(a, b, strict=True)]
        keep = pa.array([c >= m for c, m in zip(common, least, strict=True)], pa.bool_())
        return pairs.select(["a", "b"]).filter(keep)

    found = chunked.groupBy("chunk").cogroup(shipped.groupBy("part")).applyInArrow(count, "a long, b long")
    found = written(found, name, free=True)
    remove(ordered)
    return found


def fingerprint_pairs(named: DataFrame, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(a, b)``: sets that their SimHash fingerprints link.

    ``named`` has ``(fp, n, bits)`` a set; ``near`` links different fingerprints within its radius.  Sets of one fingerprint
    are paired with the least of them, and the least ones of two linked fingerprints with each other, so pairs are in proportion to the sets.
    """
    sets = named.where("n > 0").select("fp", "bits")
    least = written(sets.groupBy("bits").agg(F.min("fp").alias("least")), "least_sets")
    same = sets.join(least, "bits").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    links = near(least.select(F.col("bits").alias("fp")))
    one, two = (least.select(F.col("bits").alias(k), F.col("least").alias(f"set_{k}")) for k in "ab")
    linked = links.join(one, "a").join(two, "b").select(F.greatest("set_a", "set_b").alias("a"), F.least("set_a", "set_b").alias("b"))
    return same.unionByName(linked)


def similar_links(
    docs: DataFrame, text_col: str, prints: DataFrame, shingle: int, similarity: float, near: Callable[[DataFrame], DataFrame],
    crowd: int = CROWD,
) -> DataFrame:
    """``(a, b)`` links of set names whose components are those of all pairs of at least ``similarity``.

    ``prints`` are :func:`set_prints`, ``near`` links their SimHash fingerprints.  Null and empty texts are the empty set, which has no links; repeated rows are one set.  Tables of
    a step are removed when the next is written.  ``crowd`` decides the work of a task, never the result.
    """
    # one text of each set; equal texts are one row
    named = written(prints.groupBy("fp").agg(F.min("mark").alias("mark"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bits").alias("bits")), "named", free=True)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.xxhash64(text).alias("mark"), as_bytes(text).alias("text"))
    told = _verified(fingerprint_pairs(named, near), rows, named, shingle, similarity, "fingerprint_links")
    shared = written(_shared(rows, shingle, similarity), "first_shingles", free=True)
    kinds = "a long, b long"

    def ordered(df: DataFrame) -> DataFrame:
        return df.repartition("token").sortWithinPartitions("token", "n", "fp")

    beside = ordered(shared.withColumn("root", F.col("fp"))).mapInArrow(_pairs(similarity, 1), kinds).join(told, ["a", "b"], "left_anti")
    links = told.unionByName(_verified(beside, rows, named, shingle, similarity, "near_links"))
    roots = written(components(links).select(F.col("key").alias("fp"), "root"), "near_roots")
    rooted = written(shared.join(roots, "fp", "left").select("token", "fp", "n", "at", F.coalesce("root", "fp").alias("root")), "rooted", free=True)
    remove(shared)
    open_ = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("held"))
    open_ = written(open_.where("low < high").select("token", "held"), "open", free=True)
    before = Window.partitionBy("fp").orderBy("at").rowsBetween(-EARLIER, -1)
    # filled up with the set's own name, which no other row carries
    earlier = F.slice(F.concat(F.collect_list("token").over(before), F.array_repeat("fp", EARLIER)), 1, EARLIER)
    met = written(rooted.join(open_, "token").withColumn("earlier", earlier), "met", free=True)
    rest = ordered(_blocks(met.join(_briefs(named), "fp"), crowd)).mapInArrow(_pairs(similarity, None), kinds)
    far = _verified(rest, rows, named, shingle, similarity, "far_links")
    remove(met)
    remove(rooted)
    return links.unionByName(far)
