"""Mixing sources to target weights by entropy balancing.

Document rates are the ones nearest to one, in relative entropy, whose words meet each
source's target with no rate above ``most``: ``rate = min(most, exp(lam * size / scale))``
with one multiplier per source.  The multipliers are the maximum of a concave dual, found
by Newton steps that are one aggregation each.  All rows of a source and size have one
rate, so the steps run on those cells, not on documents.

Rates become whole copies by systematic rounding in the order of size, whose error is
below one document; a few cells are then moved by whole documents to meet the rest.
Sums that decide are decimals, so the order of the rows never matters and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import WORD, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
# Parts a cell of equal source and size is dealt into when its extra copies are dealt out.
PARTS = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _exact(value: Column) -> Column:
    return value.cast("decimal(28,8)")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, ...)`` -> with ``k``, the place by code point (null last), and ``target``.

    Weights repeat along ``k``.  A target stops at ``most`` times its source's size and the excess is shared
    out again by weight until none is above: the shares are ``min(cap, weight * level)`` for the
    one level at which they sum to the whole, found by sorting the sources by cap / weight.  One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.row_number().over(by_name) - 1
    weighted = sources.withColumn("k", k)
    cycle = F.pmod(F.col("k"), F.lit(len(weights)))
    weight = F.lit(weights[-1])
    for n, w in enumerate(weights[:-1]):
        weight = F.when(cycle == n, F.lit(w)).otherwise(weight)
    cap = (F.col("source_size") * most).cast("double")
    weighted = weighted.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "k")
    whole = Window.partitionBy()
    weighted = weighted.withColumn(
        "level",
        (share * F.sum("source_size").over(whole) - F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)).cast("double"))
        / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    weighted = weighted.withColumn("level", F.coalesce("level", share * F.sum("source_size").over(whole) / F.sum("weight").over(whole)))
    # the first level that its own source's cap does not reach holds for all; past it caps only rise
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "k", "level"))).over(whole)["level"]
    return weighted.withColumn("target", F.least("cap", F.coalesce(F.col("weight") * level, "cap"))).drop("weight", "cap", "ratio", "level")


def _newton(cells: DataFrame, plan: DataFrame, most: int, steps: int, close: float) -> DataFrame:
    """``(k, lam)``: the multiplier of each source that has a target.

    Newton's step on the logarithm of the words taken; a step that leaves the bracket known so far halves it.
    """
    # a source whose target is its cap is done at once: all its rates are the most
    start = F.when(F.col("target") >= F.col("source_size") * most, F.lit(most).cast("double") * F.col("scale") / F.col("least")).otherwise(F.lit(0.0))
    state = written(
        plan.where("target > 0").join(cells.groupBy("k").agg(F.min("size").alias("least")), "k").select(
            "k", "target", "scale", start.alias("lam"),
            (F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))) * F.col("scale") / F.col("least")).alias("low"),
            (F.lit(most).cast("double") * F.col("scale") / F.col("least")).alias("high")), "multipliers")
    for _ in range(steps):
        x = F.col("size") / F.col("scale")
        rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("lam") * x, F.lit(50.0))))
        words = F.col("n") * F.col("size") * rate
        sums = cells.join(state, "k").groupBy("k").agg(
            F.sum(_exact(words)).cast("double").alias("f"),
            F.sum(_exact(F.when(rate < most, words * x).otherwise(0.0))).cast("double").alias("slope"))
        over = F.col("f") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("high"))
        step = F.col("lam") - F.when((F.col("slope") > 0) & (F.col("f") > 0), F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("slope"))
        moved = state.join(sums, "k").select("k", "target", "scale", "lam", low.alias("low"), high.alias("high"), step.alias("step"),
                                             (F.abs(F.col("f") - F.col("target")) / F.col("target")).alias("off"))
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        moved = written(moved.select(
            "k", "target", "scale",
            F.when(F.col("off") <= close, F.col("lam")).when(inside, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2).alias("lam"),
            "low", "high", "off"), "multipliers")
        state = moved.drop("off")
        worst = moved.agg(F.max("off")).first()[0]
        if worst is None or worst <= close:
            break
    return state.select("k", "lam")


def _met(cells: DataFrame, most: int, passes: int) -> DataFrame:
    """``cells`` with ``copies`` moved so that each source's words near its target.

    A pass goes down the sizes that fit into the rest and moves as many copies of each as still fit.
    """
    own = Window.partitionBy("k")
    larger = own.orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    for _ in range(passes):
        cells = cells.withColumn("rest", F.col("target") - F.sum(F.col("copies") * F.col("size")).over(own))
        room = F.when(F.col("rest") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("rest"))
        cells = cells.withColumn("room", F.when(fits, room).otherwise(F.lit(0)))
        used = F.coalesce(F.sum(F.col("room") * F.col("size")).over(larger), F.lit(0))
        moved = F.floor((F.abs("rest") - used) / F.greatest(F.col("size"), F.lit(1)))
        moved = F.least(F.col("room"), F.greatest(moved, F.lit(0))) * F.signum("rest").cast("long")
        cells = cells.withColumn("copies", F.col("copies") + moved).drop("rest", "room")
    return cells


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights=WEIGHTS,
    share: float = SHARE, most: int = MOST, parts: int = PARTS, steps: int = 60, close: float = 1e-7, passes: int = 4,
) -> DataFrame:
    """``(id_col, size, source_size, target, rate, copies, taken, mark)`` of every row; ``taken`` is ``copies * size``.

    ``mark`` is the hash by which documents of equal source and size take turns.  A null source is one more
    source, the last.  A null text and one without words have size 0 and keep one copy.  Rows that repeat an id are
    rows of their own; ``mark`` is equal only where the text is too.  An empty table gives an empty one.
    """
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    sized = written(docs.select(
        ident.alias("id"), F.col(f"`{source_col}`").alias("source"), word_count(text).alias("size"),
        F.xxhash64(ident, text).alias("mark")), "sized")
    cells = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    sources = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("filled"))
    plan = targets(sources, weights, share, most).withColumn("scale", F.col("source_size") / F.col("filled"))
    plan = written(plan, "targets")
    named = cells.withColumnRenamed("source", "_source")
    cells = written(named.join(plan, named["_source"].eqNullSafe(plan["source"])).select("source", "k", "size", "n", "source_size", "target", "scale"), "cells")
    lam = _newton(cells.where("size > 0").select("k", "size", "n"), plan, most, steps, close)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(float(most)), F.exp(F.least(F.coalesce("lam", F.lit(0.0)) * F.col("size") / F.col("scale"), F.lit(50.0)))))
    by_size = Window.partitionBy("k").orderBy(F.col("size").desc())
    rated = cells.join(lam, "k", "left").withColumn("rate", rate)
    upto = F.sum(_exact(F.col("n") * F.col("rate"))).over(by_size)
    rated = rated.withColumn("upto", upto)
    copies = F.round("upto") - F.round(F.col("upto") - _exact(F.col("n") * F.col("rate")))
    rated = rated.withColumn("copies", F.least(copies.cast("long"), F.col("n") * most)).drop("upto", "lam", "scale")
    rated = written(_met(rated, most, passes), "copies")

    part = F.pmod("mark", F.lit(parts))
    marked = sized.withColumn("part", part)
    dealt = marked.groupBy("source", "size", "part").agg(F.count("*").alias("m"))
    renamed = rated.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "k", "n", "source_size", "target", "rate", "copies")
    dealt = dealt.join(renamed, dealt["source"].eqNullSafe(renamed["_source"]) & (F.col("size") == F.col("_size")))
    by_part = Window.partitionBy("k", "size").orderBy("part")
    extra = F.pmod("copies", F.col("n"))
    upto = F.sum("m").over(by_part)
    dealt = dealt.select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("part").alias("_part"), "k", "source_size", "target", "rate",
        F.expr("copies div n").alias("base"),
        (F.floor(extra * upto / F.col("n")) - F.floor(extra * (upto - F.col("m")) / F.col("n"))).alias("extra"))
    turn = F.row_number().over(Window.partitionBy("k", "size", "part").orderBy("mark", "id"))
    out = marked.join(dealt, marked["source"].eqNullSafe(dealt["_source"]) & (F.col("size") == F.col("_size")) & (F.col("part") == F.col("_part")))
    out = out.withColumn("copies", F.col("base") + F.when(turn <= F.col("extra"), 1).otherwise(0))
    return out.select(
        F.col("id").alias(id_col), "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"), "mark")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with its columns."""
    chosen = mix(docs, id_col, text_col, source_col, **options)
    # equal rows share a mark and the copies of all of them; one shuffle of the texts
    owed = chosen.groupBy("mark").agg(F.sum("copies").alias("_owed"), F.count("*").alias("_rows")).withColumnRenamed("mark", "_mark")
    # the row travels as one column, so no name of its own can clash
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_mark"))
    rows = rows.join(owed.where("_owed > 0"), "_mark")
    turn = F.row_number().over(Window.partitionBy("_mark").orderBy("_mark"))
    copies = F.expr("_owed div _rows") + F.when(turn <= F.col("_owed") % F.col("_rows"), 1).otherwise(0)
    rows = rows.withColumn("_copies", copies.cast("int")).where("_copies > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
