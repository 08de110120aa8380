"""Segmentation of runs of letters into the words of a dictionary table, by the best way through the word lattice.

A run is a row of units: Latin letters and digits that stand together are one unit, any other letter is one by
itself.  A way cuts a run into listed words and, between them, single units.  The best way has the most characters in
listed words, then the fewest pieces, then the longer piece first.

The dictionary is a table of any size and never leaves the executors: words that start at a unit are found by equi-joins,
first on the unit (which lengths to try), then on the piece.  Places that no word spans cut a run into stretches, and
a stretch is decided by one ``aggregate`` from its end, so the work follows the overlaps and not the length of a run.
Each distinct run is cut once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import WORD
from millrace.operators.logs import is_keyword_search

UNIT = r"[a-z0-9]+|[\p{L}\p{N}]"
# Units of the longest run that is decided as one stretch.
WHOLE = 64


def runs_of(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits of a text, in order."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _units(column: str, unit: str) -> Column:
    return F.regexp_extract_all(F.col(column), F.lit(unit), F.lit(0))


def _listed(dictionary: DataFrame, word: str, unit: str) -> DataFrame:
    """``(piece, first, n)``: the words with their first unit and number of units; a word that is not units only is left out."""
    words = dictionary.select(F.lower(word).alias("piece")).where("piece <> ''").distinct()
    words = words.withColumn("_u", _units("piece", unit)).where(F.array_join("_u", "") == F.col("piece"))
    return words.select("piece", F.col("_u")[0].alias("first"), F.size("_u").alias("n"))


def _best_way(stretch: Column) -> Column:
    """Pieces of a stretch: an array of ``(at, unit, ns)``, ``ns`` the lengths of the words that start there."""
    last = F.size(stretch) - 1
    nothing = F.array(F.struct(F.lit(0).alias("chars"), F.lit(0).alias("pieces"), F.lit(0).alias("n")))

    def decide(ahead: Column, k: Column) -> Column:
        """``ahead``: the best from each later place, the next one first; ``pieces`` counts down."""
        here = F.get(stretch, k)
        by = lambda n, chars: F.struct(
            (F.get(ahead, n - 1)["chars"] + chars).alias("chars"), (F.get(ahead, n - 1)["pieces"] - 1).alias("pieces"), n.alias("n"))
        words = F.transform(here["ns"], lambda w: by(w["n"], w["chars"]))
        return F.concat(F.array(F.array_max(F.concat(words, F.array(by(F.lit(1), F.lit(0)))))), ahead)

    back = F.transform(F.sequence(F.lit(0), last), lambda k: last - k)
    ways = F.aggregate(back, nothing, decide)

    def pieces(ways: Column) -> Column:
        starts = F.aggregate(
            F.sequence(F.lit(0), last), F.struct(F.lit(0).alias("next"), F.array().cast("array<int>").alias("at")),
            lambda s, k: F.when(s["next"] == k, F.struct((k + F.get(ways, k)["n"]).alias("next"), F.array_append(s["at"], k).alias("at"))).otherwise(s),
            lambda s: s["at"])
        return F.transform(starts, lambda k: F.array_join(F.transform(F.slice(stretch, k + 1, F.get(ways, k)["n"]), lambda x: x["unit"]), ""))

    return F.transform(F.array(ways), pieces)[0]  # bound to a name, so that it is decided once


def _lattice(lines: Column, hits: Column) -> Column:
    """The stretch of a whole run: its units with the words ``hits`` (at, n, chars) that start there."""
    return F.transform(lines, lambda u, k: F.struct(
        k.alias("at"), u.alias("unit"),
        F.transform(F.filter(hits, lambda h: h["at"] == k), lambda h: F.struct(h["n"].alias("n"), h["chars"].alias("chars"))).alias("ns")))


def _whole(cut: DataFrame, listed: DataFrame) -> DataFrame:
    """Runs (run, _u) as one stretch each: their places are brought together once, by run."""
    lengths = listed.groupBy("first").agg(F.collect_set("n").alias("lens"))
    places = cut.select("run", "_u", F.posexplode("_u").alias("at", "unit"))
    tried = places.join(lengths, F.col("unit") == F.col("first"), "left").select(
        "run", "at", "_u", F.explode_outer(F.filter("lens", lambda n: n <= F.size("_u") - F.col("at"))).alias("n"))
    tried = tried.select("run", "at", "n", F.array_join(F.slice("_u", F.col("at") + 1, F.coalesce("n", F.lit(0))), "").alias("_piece"))
    found = tried.join(listed.select("piece"), F.col("_piece") == F.col("piece"), "left")
    hit = F.when(F.col("piece").isNotNull(), F.struct("at", "n", F.length("piece").alias("chars")))
    return found.groupBy("run").agg(F.collect_list(hit).alias("hits"))


def segmented(runs: DataFrame, dictionary: DataFrame, run: str = "run", word: str = "word", unit: str = UNIT) -> DataFrame:
    """``(run, words)`` of every different run; ``words`` are its pieces in order.

    Null runs are left out; an empty dictionary cuts a run into its units.  Runs of at most ``WHOLE`` units are one stretch;
    only longer ones are cut into stretches.
    """
    listed = _listed(dictionary, word, unit)
    cut = runs.select(F.lower(run).alias("run")).where("run IS NOT NULL").distinct()
    # work on every place of a run: dealt to all cores, however few bytes the runs are
    cut = cut.repartition(3 * runs.sparkSession.sparkContext.defaultParallelism, "run")
    cut = cut.withColumn("_u", _units("run", unit)).where(F.size("_u") > 0)
    short = _whole(cut.where(F.size("_u") <= WHOLE), listed).select("run", F.transform(
        F.array(_lattice(_units("run", unit), F.col("hits"))), _best_way)[0].alias("words"))
    pieces = short.unionByName(_in_stretches(cut.where(F.size("_u") > WHOLE), listed))
    return pieces.select(F.col("run").alias(run), "words")


def _in_stretches(cut: DataFrame, listed: DataFrame) -> DataFrame:
    """``(run, words)`` of runs (run, _u) of any length."""
    # the longest word bounds what a place carries; one row, joined by a key that is always zero
    longest = listed.groupBy(F.pmod("n", F.lit(1)).alias("_one")).agg(F.max("n").alias("longest"))
    cut = cut.withColumn("_one", F.pmod(F.length("run"), F.lit(1))).join(longest, "_one", "left")
    cut = cut.withColumn("longest", F.coalesce("longest", F.lit(1)))
    places = cut.select("run", F.posexplode(F.transform("_u", lambda u, k: F.struct(
        u.alias("unit"), F.slice(F.col("_u"), k + 1, F.col("longest")).alias("ahead")))).alias("at", "_p")).select("run", "at", "_p.unit", "_p.ahead")
    lengths = listed.groupBy("first").agg(F.collect_set("n").alias("lens"))
    tried = places.join(lengths, F.col("unit") == F.col("first")).select(
        "run", "at", "ahead", F.explode(F.filter("lens", lambda n: n <= F.size("ahead"))).alias("n"))
    tried = tried.select("run", "at", "n", F.array_join(F.slice("ahead", 1, F.col("n")), "").alias("piece"))
    found = tried.join(listed.select("piece"), "piece", "left_semi").groupBy("run", "at").agg(
        F.collect_list(F.struct("n", F.length("piece").alias("chars"))).alias("ns"), F.max(F.col("at") + F.col("n")).alias("end"))
    # a place is joined to what starts there; the words reach as far as the furthest end so far
    line = Window.partitionBy("run").orderBy("at")
    lattice = places.select("run", "at", "unit").join(found, ["run", "at"], "left").select(
        "run", "at", "unit", F.coalesce("ns", F.array().cast("array<struct<n:int,chars:int>>")).alias("ns"), F.coalesce("end", F.col("at") + 1).alias("end"))
    spanned = F.coalesce(F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lattice = lattice.withColumn("_new", (F.col("at") >= spanned).cast("int")).withColumn("stretch", F.sum("_new").over(line))
    stretches = lattice.groupBy("run", "stretch").agg(F.array_sort(F.collect_list(F.struct("at", "unit", "ns"))).alias("line"))
    pieces = stretches.select("run", "stretch", F.transform(F.array("line"), _best_way)[0].alias("pieces"))
    return pieces.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("stretch", "pieces"))).alias("all")).select(
        "run", F.flatten(F.transform("all", lambda s: s["pieces"])).alias("words"))


def smart_words(rows: DataFrame, text: str, dictionary: DataFrame, word: str = "word", unit: str = UNIT) -> DataFrame:
    """``rows`` with ``words``: the pieces of all runs of their text in order; none for a text without letters, null for null.

    Meant for short texts that repeat, such as searches: each different one is cut once and joined back by itself.
    """
    texts = rows.select(F.col(text).alias("_text")).where("_text IS NOT NULL").distinct()
    placed = texts.select("_text", F.posexplode(runs_of("_text")).alias("_at", "run"))
    cut = segmented(placed.select("run"), dictionary, word=word, unit=unit)
    by_text = placed.join(cut, "run").groupBy("_text").agg(F.array_sort(F.collect_list(F.struct("_at", "words"))).alias("_all"))
    joined = rows.join(by_text, F.col(text) == F.col("_text"), "left")
    words = F.flatten(F.transform("_all", lambda r: r["words"]))
    empty = F.when(F.col(text).isNotNull(), F.array().cast("array<string>"))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(words, empty).alias("words"))


def run_counts(rows: DataFrame, text: str) -> DataFrame:
    """``(run, m)``: every different run of the texts with how often it is there.

    The barrier keeps filters and unused columns out of the count, so a query that takes it several times counts once.
    """
    runs = rows.select(F.explode(runs_of(text)).alias("run")).groupBy("run").agg(F.count("*").alias("m"))
    return runs.select(F.inline(F.array(F.struct("run", "m"))))


def word_counts(rows: DataFrame, text: str, dictionary: DataFrame, word: str = "word", unit: str = UNIT) -> DataFrame:
    """``(word, ct)`` over all texts.  Runs are counted before they are cut, so a frequent one is cut and joined once."""
    return counted_words(run_counts(rows, text), dictionary, word, unit)


def counted_words(runs: DataFrame, dictionary: DataFrame, word: str = "word", unit: str = UNIT) -> DataFrame:
    """``(word, ct)`` over :func:`run_counts`."""
    cut = segmented(runs, dictionary, word=word, unit=unit)
    return runs.join(cut, "run").select(F.explode("words").alias("word"), "m").groupBy("word").agg(F.sum("m").alias("ct"))


def keyword_searches(pages: DataFrame, dictionary: DataFrame, word: str = "word", unit: str = UNIT) -> DataFrame:
    """One row per word of each keyword search: ``(keyword, ts)``, for windowed counts."""
    searches = pages.where(is_keyword_search()).select(F.col("page.item").alias("item"), "ts")
    return smart_words(searches, "item", dictionary, word, unit).select(F.explode("words").alias("keyword"), "ts")
