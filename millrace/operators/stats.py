"""Windowed statistics.  The same functions serve batch and streaming frames.

Distinct counts are two aggregations: first per (window, group, counted id),
then per (window, group).  The first one spreads a hot group over its ids, and
unlike a distinct aggregate it is accepted on streams.  On a stream the union of
sources must carry one watermark per source, so that the slowest source holds
the windows open.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.codes import APPRAISE_GOOD, KEYWORD_SEARCH
from millrace.functions.moments import (
    event_time, from_millis, from_millis_whole_seconds, with_window_bounds,
)
from millrace.functions.text import tokenize
from millrace.operators.logs import is_keyword_search, starts_session

WINDOW = "10 seconds"


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _watermarked(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    return df.withWatermark(time, delay) if delay else df


# -- visitors ---------------------------------------------------------------

_VISITOR_KEYS = ["vc", "ch", "ar", "is_new"]
_VISITOR_SUMS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def visitor_rows(logs: DataFrame, delay: str | None = None, **counts: Column) -> DataFrame:
    """Project page records onto the visitor statistics row; absent counts are 0."""
    rows = logs.select(
        from_millis("ts").alias("event_time"), *_VISITOR_KEYS,
        *[counts.get(n, F.lit(0)).cast("long").alias(n) for n in _VISITOR_SUMS], "ts",
    )
    return _watermarked(rows, "event_time", delay)


def visitor_stats(
    pages: DataFrame, visits: DataFrame, jumps: DataFrame | None = None, window: str = WINDOW, delay: str | None = None
) -> DataFrame:
    """Unique visits, pages, sessions, bounces and time spent per visitor group.

    Without ``jumps`` the pages say themselves, in ``bounced``, whether they are bounces.
    """
    session = F.when(starts_session(), 1).otherwise(0)
    own = {} if jumps is not None else {"uj_ct": F.col("bounced").cast("long")}
    sources = [
        visitor_rows(visits, delay, uv_ct=F.lit(1)),
        visitor_rows(
            pages, delay, pv_ct=F.lit(1), sv_ct=session,
            dur_sum=F.coalesce(F.col("page.during_time"), F.lit(0)), **own,
        ),
    ]
    rows = _union(sources if jumps is None else [*sources, visitor_rows(jumps, delay, uj_ct=F.lit(1))])
    stats = rows.groupBy(F.window("event_time", window), *_VISITOR_KEYS).agg(
        *[F.sum(n).alias(n) for n in _VISITOR_SUMS], F.max("ts").alias("ts")
    )
    return with_window_bounds(stats)


# -- products ---------------------------------------------------------------

# What a product row can be.  Each kind of row carries at most one number and one
# amount, so rows stay narrow until the last aggregation.
_ROW_COUNTS = {
    "display_ct": "display", "click_ct": "click", "favor_ct": "favor", "cart_ct": "cart", "comment_ct": "comment",
}
_NUMBER_SUMS = {"order_sku_num": "order", "good_comment_ct": "comment"}
_AMOUNT_SUMS = {"order_amount": "order", "payment_amount": "payment", "refund_amount": "refund"}
_ORDER_COUNTS = {"order_ct": "order", "paid_order_ct": "payment", "refund_order_ct": "refund"}


def product_rows(
    df: DataFrame,
    kind: str | Column,
    sku: str,
    time: Column,
    delay: str | None = None,
    order: str | None = None,
    number: Column | None = None,
    amount: Column | None = None,
) -> DataFrame:
    """Project one source onto the product row: kind, sku, time, order id, number, amount."""
    rows = df.select(
        time.alias("event_time"),
        F.col(sku).try_cast("long").alias("sku_id"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        (F.col(order) if order else F.lit(None)).cast("long").alias("order_id"),
        F.lit(0 if number is None else number).cast("long").alias("number"),
        F.lit(0 if amount is None else amount).cast("decimal(16,2)").alias("amount"),
    )
    return _watermarked(rows, "event_time", delay)


def rows_in_one_pass(
    df: DataFrame, sku: str, time: Column, order: str, kinds: Sequence[tuple[str, Column | None, Column | None, Column | None]],
    delay: str | None = None,
) -> DataFrame:
    """Several kinds of product rows from one read of a source: (kind, when, number, amount) each; ``when`` None is always."""
    facts = []
    for kind, when, number, amount in kinds:
        fact = F.struct(
            F.lit(kind).alias("kind"), F.col(order).cast("long").alias("order_id"),
            F.lit(0 if number is None else number).cast("long").alias("number"),
            F.lit(0 if amount is None else amount).cast("decimal(16,2)").alias("amount"))
        facts.append(fact if when is None else F.when(when, fact))
    rows = _watermarked(df.withColumn("event_time", time), "event_time", delay)
    made = F.filter(F.array(*facts), lambda f: f.isNotNull())
    return rows.select("event_time", F.col(sku).try_cast("long").alias("sku_id"), F.inline(made))


def page_rows(pages: DataFrame, delay: str | None = None) -> DataFrame:
    """Clicks (a product's detail page) and displays of products, in one pass.

    The watermark sits on all pages, so it moves even while nothing is clicked.
    """
    item = lambda value, kind: F.struct(value.alias("item"), F.lit(kind).alias("kind"))
    clicked = (F.col("page.page_id") == "good_detail") & (F.col("page.item_type") == "sku_id")
    click = F.filter(F.array(item(F.col("page.item"), "click")), lambda _: clicked)
    shown = F.filter(F.coalesce("displays", F.array()), lambda d: d["item_type"] == "sku_id")
    display = F.transform(shown, lambda d: item(d["item"], "display"))
    rows = pages.withColumn("event_time", from_millis("ts"))
    rows = _watermarked(rows, "event_time", delay).select("event_time", F.inline_outer(F.concat(click, display)))
    return product_rows(rows.where(F.col("kind").isNotNull()), F.col("kind"), "item", F.col("event_time"))


def favor_rows(favors: DataFrame, delay: str | None = None) -> DataFrame:
    return product_rows(favors, "favor", "sku_id", event_time(favors, "create_time"), delay)


def cart_rows(carts: DataFrame, delay: str | None = None) -> DataFrame:
    return product_rows(carts, "cart", "sku_id", event_time(carts, "create_time"), delay)


def order_rows(wide: DataFrame, delay: str | None = None, amount: str = "split_total_amount") -> DataFrame:
    """``amount`` is the detail's share; pass ``total_amount`` to count the whole order per detail."""
    return product_rows(
        wide, "order", "sku_id", event_time(wide, "create_time"), delay, "order_id", F.col("sku_num"), F.col(amount)
    )


def payment_rows(paid: DataFrame, delay: str | None = None, amount: str = "split_total_amount") -> DataFrame:
    return product_rows(
        paid, "payment", "sku_id", event_time(paid, "payment_create_time"), delay, "order_id", amount=F.col(amount)
    )


def refund_rows(refunds: DataFrame, delay: str | None = None) -> DataFrame:
    return product_rows(
        refunds, "refund", "sku_id", event_time(refunds, "create_time"), delay, "order_id",
        amount=F.col("refund_amount"),
    )


def comment_rows(comments: DataFrame, delay: str | None = None) -> DataFrame:
    good = F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0)
    return product_rows(comments, "comment", "sku_id", event_time(comments, "create_time"), delay, number=good)


def product_stats(rows: Iterable[DataFrame], window: str = WINDOW) -> DataFrame:
    """Sums and exact distinct order counts per sku; join dimensions afterwards."""
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    # One row per order whatever its kinds, so that the rows of one order line travel as one.
    sums = {
        **{n: of(kind, 1) for n, kind in _ROW_COUNTS.items()}, **{n: of(kind, F.col("number")) for n, kind in _NUMBER_SUMS.items()},
        **{n: of(kind, F.col("amount")) for n, kind in _AMOUNT_SUMS.items()},
    }
    per_order = _union(rows).groupBy(F.window("event_time", window), "sku_id", "order_id").agg(
        *[F.sum(value).alias(n) for n, value in sums.items()],
        *[F.max(of(kind, F.col("order_id").isNotNull().cast("int"))).alias(n) for n, kind in _ORDER_COUNTS.items()],
        F.max(F.unix_millis("event_time")).alias("ts"),
    )
    stats = per_order.groupBy("window", "sku_id").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in (*sums, *_ORDER_COUNTS)], F.max("ts").alias("ts"))
    return with_window_bounds(stats)


# -- provinces --------------------------------------------------------------

PROVINCE_KEYS = [
    "province_id", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
]


def province_stats(
    wide: DataFrame,
    window: str = WINDOW,
    delay: str | None = None,
    amount: str = "split_total_amount",
    keys: Sequence[str] = PROVINCE_KEYS,
) -> DataFrame:
    """Amount and distinct orders per province.

    A ``event_time`` column, as :func:`order_wide` gives it, is used as it is;
    otherwise the time is read from ``create_time`` under the watermark ``delay``.
    With ``keys=["province_id"]`` the names can be joined to the result instead
    of to every order line.
    """
    rows = wide
    if "event_time" not in wide.columns:
        rows = _watermarked(wide.withColumn("event_time", event_time(wide, "create_time")), "event_time", delay)
    exact = wide.schema[amount].dataType.typeName() == "decimal"
    value = F.col(amount) if exact else F.col(amount).cast("decimal(16,2)")
    per_order = rows.groupBy(F.window("event_time", window), *keys, "order_id").agg(
        F.sum(value).alias("order_amount"),
        F.max(F.unix_millis("event_time")).alias("ts"),
    )
    stats = per_order.groupBy("window", *keys).agg(
        F.sum("order_amount").alias("order_amount"),
        F.count("order_id").alias("order_count"),
        F.max("ts").alias("ts"),
    )
    return with_window_bounds(stats)


# -- keywords ---------------------------------------------------------------

def keyword_stats(
    pages: DataFrame,
    window: str = WINDOW,
    delay: str | None = None,
    source: str = KEYWORD_SEARCH,
    words: Iterable[str] = (),
) -> DataFrame:
    """How often each word of the search texts was searched."""
    rows = pages.withColumn("event_time", from_millis_whole_seconds("ts"))
    # On a stream the watermark is on all pages, so that windows close while nobody
    # searches; in batch the filter comes first and can reach the files.
    rows = rows.withWatermark("event_time", delay) if delay else rows.where(is_keyword_search())
    text = F.when(is_keyword_search(), F.col("page.item"))
    found = rows.select("event_time", "ts", F.explode_outer(tokenize(text, words)).alias("keyword"))
    found = found.where(F.col("keyword").isNotNull())
    stats = found.groupBy(F.window("event_time", window), "keyword").agg(
        F.count("*").alias("ct"), F.max("ts").alias("ts")
    )
    return with_window_bounds(stats.withColumn("source", F.lit(source)))
