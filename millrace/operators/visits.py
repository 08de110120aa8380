"""Device visits: new-visitor repair, daily first visits, bounces."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.moments import day_of, from_millis, hour_of
from millrace.operators.latest import first_by_key
from millrace.operators.logs import is_entry

TIE = "log_id"


def repair_is_new(logs: DataFrame, tie: str = TIE) -> DataFrame:
    """Of a device's records claiming ``is_new = 1`` only the earliest keeps the claim.

    The earliest claim time per device is a pre-aggregated minimum.  It is joined
    back on (device, time) and the tie is broken inside (device, time), so a
    device with a large share of the rows never meets in one task.
    """
    claim = F.col("is_new") == "1"
    firsts = logs.where(claim).groupBy("mid").agg(F.min("ts").alias("ts"))
    firsts = firsts.withColumn("_first", F.lit(True))
    place = F.row_number().over(Window.partitionBy("mid", "ts", "is_new").orderBy(tie))
    marked = logs.join(firsts, ["mid", "ts"], "left").withColumn("_place", place)
    keeps = F.col("_first") & (F.col("_place") == 1)
    # A record without a device has no history to repair against.
    repaired = F.when(claim & F.col("mid").isNotNull() & ~F.coalesce(keeps, F.lit(False)), "0")
    return marked.withColumn("is_new", F.coalesce(repaired, F.col("is_new"))).select(*logs.columns)


def with_log_time(df: DataFrame) -> DataFrame:
    """``logDate`` and ``logHour`` of the epoch-millisecond ``ts``."""
    time = from_millis("ts")
    return df.withColumns({"logDate": day_of(time), "logHour": hour_of(time)})


def unique_visits(pages: DataFrame, tie: str = TIE) -> DataFrame:
    """The first entry page of each device on each day."""
    entries = pages.where(is_entry())
    return first_by_key(entries, ["mid", day_of(from_millis("ts"))], ["ts", tie])


def daily_actives(logs: DataFrame, tie: str = TIE) -> DataFrame:
    """The first start-up log of each device on each day, with ``logDate``, ``logHour``."""
    return first_by_key(with_log_time(logs), ["mid", "logDate"], ["ts", tie])


def not_seen(fresh: DataFrame, seen: DataFrame, keys: tuple[str, ...] = ("mid", "logDate")) -> DataFrame:
    """Rows of ``fresh`` whose key is not among ``seen``."""
    return fresh.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def look_ahead(
    pages: DataFrame, time_ms: Column, within: timedelta, spans_per_cell: int = 10, spread: Column | None = None
) -> DataFrame:
    """Cut each device's pages into time cells that overlap by ``within``.

    Adds ``_cell`` and ``_own``.  Every page is once in its own cell; a page less
    than ``within`` after a cell start is also copied, as ``_own = false``, to the
    cell before, where it can only serve as the next page of another one.  A page without
    a device or a time is neither a bounce nor the end of one, and is left out; with ``spread`` it
    stays, alone in its cell or with few others by the hash of that column.
    """
    known = F.col("mid").isNotNull() & time_ms.isNotNull()
    reach = within // timedelta(milliseconds=1)
    width = reach * spans_per_cell
    cell = F.floor(time_ms / width)
    early = time_ms - cell * width < reach
    cells = F.when(early, F.array(cell, cell - 1)).otherwise(F.array(cell))
    if spread is None:
        pages = pages.where(known)
    else:
        cells = F.when(known, cells).otherwise(F.array(F.xxhash64(spread)))
    return pages.select("*", F.posexplode(cells).alias("_copy", "_cell")).withColumn(
        "_own", F.col("_copy") == 0
    ).drop("_copy")


def with_bounce(pages: DataFrame, within: timedelta = timedelta(seconds=10), tie: str = TIE) -> DataFrame:
    """Every page once, with ``bounced``: whether :func:`user_jumps` would return it.  One shuffle by (device, cell)."""
    reach = within // timedelta(milliseconds=1)
    line = Window.partitionBy("mid", "_cell").orderBy("ts", tie)
    gap = F.lead("ts").over(line) - F.col("ts")
    left = gap.isNull() | (gap >= reach) | F.lead("_entry").over(line)
    known = F.col("mid").isNotNull() & F.col("ts").isNotNull()
    cells = look_ahead(pages, F.col("ts"), within, spread=F.col(tie)).withColumn("_entry", is_entry())
    flagged = cells.withColumn("bounced", F.col("_entry") & known & left)
    return flagged.where("_own").select(*pages.columns, "bounced")


def user_jumps(
    pages: DataFrame, within: timedelta = timedelta(seconds=10), tie: str = TIE
) -> DataFrame:
    """Entry pages that were left without a further page.

    An entry page counts when the device shows no page less than ``within`` after
    it, or the next page is an entry again.  Only the next ``within`` matters, so
    the search runs per (device, time cell) instead of per device.
    """
    reach = within // timedelta(milliseconds=1)
    cells = look_ahead(pages, F.col("ts"), within)
    line = Window.partitionBy("mid", "_cell").orderBy("ts", tie)
    gap = F.lead("ts").over(line) - F.col("ts")
    next_entry = F.lead("_entry").over(line)
    bounced = gap.isNull() | (gap >= reach) | next_entry
    return (
        cells.withColumn("_entry", is_entry())
        .withColumn("_bounced", bounced)
        .where(F.col("_own") & F.col("_entry") & F.col("_bounced"))
        .select(*pages.columns)
    )
