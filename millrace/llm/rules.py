"""Quality rules learned as a decision list.

Every text gets a row of plain statistics.  From the labelled rows, sequential covering
learns ordered rules that reject: a rule grows one threshold at a time by information gain on one
part of the labelled rows, is pruned on the other part, and the rows it covers are left out of what the
next rule learns from.  Each step is one aggregation into counts by feature and bin, so any number of
labelled rows will do.  The list becomes one ordered ``CASE`` expression, evaluated by Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import SPACE, word_list, written

REPEAT_WINDOW = 5
FEATURES = (
    "n_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "distinct_share",
)
BINS = 32


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda's argument is never expanded into its uses."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(words: Column, window: int) -> Column:
    """Words inside windows that the text holds at least twice."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, i: ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["h"] == x["h"])) | (
                (i < F.size(s) - 1) & (s[F.least(i + 1, F.size(s) - 1)]["h"] == x["h"]))
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        def union(at: Column) -> Column:
            # windows at sorted places cover up to the next place, at most a window each
            gap = lambda x, i: F.when(i < F.size(at) - 1, F.least(F.lit(window), at[F.least(i + 1, F.size(at) - 1)] - x)).otherwise(window)
            return F.aggregate(F.transform(at, gap), F.lit(0), lambda total, n: total + n)

        return _bound(_bound(placed, places), union)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    starts = F.sequence(F.lit(0), F.size(words) - window)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[words[i + k] for k in range(window)]))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(_bound(hashed, count))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the base counts and the features of every row; a null text is an empty one."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    filled = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    of_words = _bound(word_list(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"), _repeated(w, REPEAT_WINDOW).cast("long").alias("n_repeat_words")))
    of_lines = _bound(filled, lambda ls: F.struct(
        F.size(ls).cast("long").alias("n_lines"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines")))
    counted = docs.select(
        F.col(f"`{id_col}`").alias(id_col), of_words.alias("w"), of_lines.alias("l"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit(r"\p{Punct}")).cast("long").alias("n_marks"))
    counted = counted.select(id_col, "w.*", "l.*", "n_symbols", "n_upper", "n_marks")
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return counted.withColumns({
        "mean_word_chars": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"), "mark_share": share("n_marks", "word_chars"),
        "distinct_share": share("n_distinct", "n_words")})


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


@dataclass(frozen=True)
class Literal:
    """``feature <= bound`` or ``feature > bound``."""

    feature: str
    above: bool
    bound: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.bound if self.above else value <= self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rejecting rules; what none of them covers is kept."""

    rules: tuple[tuple[Literal, ...], ...] = field(default=())

    def keep(self) -> Column:
        verdict = None
        for rule in self.rules:
            test = reduce(Column.__and__, (x.column() for x in rule))
            verdict = F.when(test, F.lit(False)) if verdict is None else verdict.when(test, F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, rule)) for rule in self.rules) or "keep all"


def _cuts(rows: DataFrame, features) -> dict[str, list[float]]:
    """Thresholds of every feature: its quantiles among the labelled rows."""
    found = rows.agg(*[F.percentile_approx(f, [k / BINS for k in range(1, BINS)], 10_000).alias(f) for f in features]).first()
    return {f: sorted(set(map(float, found[f] or []))) for f in features}


class _Counts:
    """Labelled rows that a conjunction covers, by feature and threshold."""

    def __init__(self, rows: DataFrame, cuts: dict[str, list[float]]):
        self.cuts = cuts
        # the bin of a value is the number of thresholds below it
        bins = [F.struct(F.lit(f).alias("f"), sum((F.col(f) > c).cast("int") for c in cs).alias("bin")) for f, cs in cuts.items() if cs]
        self.rows, self.bins = rows, bins

    def literals(self, covered: Column, grow: bool) -> tuple[tuple[int, int], list[tuple[Literal, int, int]]]:
        counts = self.rows.where(covered & (F.col("grow") == grow)).select("bad", F.inline(F.array(*self.bins))).groupBy("f", "bin").agg(
            F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
        found, whole = [], (0, 0)
        for f, cs in self.cuts.items():
            own = {r.bin: (r.p, r.n) for r in counts if r.f == f}
            if not own:
                continue
            whole = tuple(map(sum, zip(*own.values())))
            p = n = 0
            for k, c in enumerate(cs):
                p, n = p + own.get(k, (0, 0))[0], n + own.get(k, (0, 0))[1]
                found += [(Literal(f, False, c), p, n), (Literal(f, True, c), whole[0] - p, whole[1] - n)]
        return whole, found

    def prefixes(self, covered: Column, rule: list[Literal]) -> list[tuple[int, int]]:
        """Bad and good pruning rows that each beginning of a rule covers."""
        tests = [reduce(Column.__and__, (x.column() for x in rule[:k + 1])) for k in range(len(rule))]
        got = self.rows.where(covered & ~F.col("grow")).agg(*[
            x for k, t in enumerate(tests) for x in (F.sum(F.when(t, F.col("bad"))).alias(f"p{k}"), F.sum(F.when(t, 1 - F.col("bad"))).alias(f"n{k}"))]).first()
        return [(got[f"p{k}"] or 0, got[f"n{k}"] or 0) for k in range(len(rule))]


def learn(
    labelled: DataFrame, *, features=FEATURES, most_rules: int = 12, most_literals: int = 4, least_covered: int = 5,
    precision: float = 0.9,
) -> DecisionList:
    """A list from rows with ``features``, ``bad`` (0 or 1) and ``grow`` (which part the row learns in).

    A rule enters when, on the rows it was not grown on, at least ``precision`` of what it covers is bad and it covers
    ``least_covered`` rows.  Without bad or good rows the list is empty and keeps all.
    """
    rows = written(labelled.where("bad IS NOT NULL").select(*features, F.col("bad").cast("long").alias("bad"), "grow"), "labelled")
    counts = _Counts(rows, _cuts(rows, features))
    rules: list[tuple[Literal, ...]] = []
    if not counts.bins:
        return DecisionList()
    for _ in range(most_rules):
        left = DecisionList(tuple(rules)).keep()
        rule: list[Literal] = []
        covered = left
        for _ in range(most_literals):
            (p0, n0), found = counts.literals(covered, True)
            if p0 < least_covered or not n0:
                break
            gain = lambda x: x[1] * (math.log2(x[1] / (x[1] + x[2])) - math.log2(p0 / (p0 + n0))) if x[1] else 0.0
            best = max(found, key=gain)
            if gain(best) <= 1e-9:
                break
            rule.append(best[0])
            covered = covered & best[0].column()
        if not rule:
            break
        seen = counts.prefixes(left, rule)
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in seen]
        length = max(range(len(rule)), key=lambda k: (worth[k], -k))
        p, n = seen[length]
        if p + n < least_covered or p < precision * (p + n):
            break
        rules.append(tuple(rule[:length + 1]))
    return DecisionList(tuple(rules))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> tuple[DataFrame, DecisionList]:
    """Statistics of every row with ``base_failed`` and ``kept``, and the list learned from ``labels``.

    The list learns from labelled rows that pass the base rules: those it has to decide.  Unlabelled documents and null
    labels teach nothing; an id labelled more than once counts as its worst label.  With no labels only the base rules
    hold.  Rows are judged one by one, so repeated rows get equal verdicts.
    """
    stats = written(statistics(docs, id_col, text_col).withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))), "statistics")
    bad = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_labelled")).agg(F.max((F.col(label_col) == 0).cast("int")).alias("bad"))
    rows = stats.where(~F.col("base_failed")).join(bad, stats[id_col] == bad["_labelled"]).withColumn("grow", F.pmod(F.xxhash64(id_col), F.lit(3)) < 2)
    found = learn(rows, **options)
    return stats.withColumn("kept", ~F.col("base_failed") & found.keep()), found
