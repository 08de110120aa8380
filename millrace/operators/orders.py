"""Order and payment facts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.moments import day_of, day_of_text, event_time, hour_of, hour_of_text
from millrace.operators.joins import interval_join
from millrace.schemas import ORDER_WIDE_COLUMNS, PAYMENT_WIDE_COLUMNS


def with_create_parts(df: DataFrame) -> DataFrame:
    """Day and hour of ``create_time`` (text or timestamp)."""
    is_text = df.schema["create_time"].dataType.typeName() == "string"
    day, hour = (day_of_text, hour_of_text) if is_text else (day_of, hour_of)
    return df.withColumns({"create_date": day("create_time"), "create_hour": hour("create_time")})


def with_event_time(df: DataFrame, text: str = "create_time", name: str = "event_time") -> DataFrame:
    return df.withColumn(name, event_time(df, text))


# A stream has no AQE to split a hot key.
STREAM_SALTS = 4

_FROM_ORDER = [
    "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "expire_time", "create_time",
    "operate_time", "create_date", "create_hour",
]
_FROM_DETAIL = [
    "sku_id", "order_price", "sku_num", "sku_name", "split_activity_amount", "split_coupon_amount",
    "split_total_amount",
]


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    lower: timedelta = timedelta(seconds=-5),
    upper: timedelta = timedelta(seconds=5),
    delay: str | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Each order detail with its order, when created within the bounds of it.

    ``delay`` sets the watermark of both sides for a streaming run, where the join
    is salted against a hot order (see :func:`interval_join`).
    ``event_time`` of the result is the order's.
    """
    orders = with_event_time(with_create_parts(orders))
    orders = orders.select(F.col("id").alias("order_id"), *_FROM_ORDER, "event_time")
    details = with_event_time(details, name="detail_time")
    details = details.select(
        F.col("id").alias("detail_id"), F.col("order_id").alias("_order"), *_FROM_DETAIL, "detail_time"
    )
    if delay:
        orders = orders.withWatermark("event_time", delay)
        details = details.withWatermark("detail_time", delay)
    wide = interval_join(
        orders, details, left_key="order_id", right_key="_order", left_time="event_time",
        right_time="detail_time", lower=lower, upper=upper,
        salts=salts or (STREAM_SALTS if delay else 1),
    )
    # No source record holds the freight share of a single detail.
    return wide.withColumn("split_feight_fee", F.lit(None).cast("decimal(16,2)")).drop("_order", "detail_time")


def payment_wide(
    payments: DataFrame,
    wide: DataFrame,
    lower: timedelta = timedelta(minutes=-15),
    upper: timedelta = timedelta(seconds=5),
    delay: str | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Each payment with the wide order rows created within its bounds.

    Where both records have a column (order, user, total amount), the payment's
    value is kept.
    """
    payments = with_event_time(payments, name="payment_time").select(
        F.col("id").alias("payment_id"), "order_id", "user_id", "total_amount", "subject",
        "payment_type", F.col("create_time").alias("payment_create_time"), "callback_time",
        "payment_time",
    )
    wide = with_event_time(wide).withColumnsRenamed(
        {"create_time": "order_create_time", "order_id": "_order"}
    ).drop("user_id", "total_amount", "create_date", "create_hour", "expire_time", "operate_time")
    if delay:
        payments = payments.withWatermark("payment_time", delay)
        wide = wide.withWatermark("event_time", delay)
    joined = interval_join(
        payments, wide, left_key="order_id", right_key="_order", left_time="payment_time",
        right_time="event_time", lower=lower, upper=upper,
        salts=salts or (STREAM_SALTS if delay else 1),
    )
    return joined.drop("_order", "event_time")


def order_wide_table(enriched: DataFrame) -> DataFrame:
    return enriched.select(*ORDER_WIDE_COLUMNS)


def payment_wide_table(joined: DataFrame) -> DataFrame:
    return joined.select(*PAYMENT_WIDE_COLUMNS)
