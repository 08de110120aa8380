"""Feeds: a name, the schema of its records, and how to read it.

A feed is a topic (Kafka) or a folder of text lines (files); both give a frame
with the line in ``value``, batch or streaming.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.operators.logs import parse_clean
from millrace.sinks.kafka import MESSAGE_ID, message_id_of


@dataclass(frozen=True)
class Feed:
    name: str
    schema: T.StructType
    topic: str = ""

    def __post_init__(self):
        object.__setattr__(self, "topic", self.topic or self.name)


FEEDS = {
    f.name: f
    for f in [
        Feed("ods_base_log", schemas.LOG_LINE),
        Feed("ods_base_db", schemas.CHANGE),
        Feed("dwd_start_log", schemas.LOG_LINE),
        Feed("dwd_page_log", schemas.LOG_LINE),
        Feed("dwd_display_log", schemas.DISPLAY),
        Feed("dwm_unique_visit", schemas.LOG_LINE),
        Feed("dwm_user_jump_detail", schemas.LOG_LINE),
        Feed("dwd_order_info", schemas.ORDER_INFO),
        Feed("dwd_order_detail", schemas.ORDER_DETAIL),
        Feed("dwd_payment_info", schemas.PAYMENT_INFO),
        Feed("dwd_favor_info", schemas.FAVOR),
        Feed("dwd_cart_info", schemas.CART),
        Feed("dwd_order_refund_info", schemas.REFUND),
        Feed("dwd_comment_info", schemas.COMMENT),
        Feed("dwm_order_wide", schemas.ORDER_WIDE),
        Feed("dwm_payment_wide", schemas.PAYMENT_WIDE),
        Feed("startup_log", schemas.STARTUP_LOG),
        Feed("event_log", schemas.EVENT_LOG),
        Feed("shop_order", schemas.SHOP_ORDER),
        Feed("shop_order_detail", schemas.SHOP_DETAIL),
        Feed("shop_user", schemas.USER_INFO),
    ]
}


def kafka_options(servers: str, topic: str, group: str | None = None, start: str = "latest") -> dict[str, str]:
    """Source options.  Offsets live in the query's checkpoint, not in the group."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if group:
        options["groupIdPrefix"] = group
    return options


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    streaming: bool = True,
    group: str | None = None,
    start: str | None = None,
    extra: Mapping[str, str] | None = None,
    message_ids: bool = False,
) -> DataFrame:
    """Lines of a topic with their place in it.  A batch read covers what the topic holds.

    ``message_ids`` adds the column ``message_id`` that :func:`millrace.sinks.kafka.with_headers` sends, for ``once``.
    """
    start = start or ("latest" if streaming else "earliest")
    reader = spark.readStream if streaming else spark.read
    options = {**kafka_options(servers, topic, group, start), **(extra or {})}
    columns = ["CAST(value AS STRING) AS value", "topic", "partition", "offset", "timestamp"]
    if not message_ids:
        return reader.format("kafka").options(**options).load().selectExpr(*columns)
    rows = reader.format("kafka").options(**options, includeHeaders="true").load()
    return rows.withColumn(MESSAGE_ID, message_id_of(F.col("headers"))).selectExpr(*columns, MESSAGE_ID)


def read_files(
    spark: SparkSession, path: str, *, streaming: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the text files in a folder; ``timestamp`` is when the file was written."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.format("text").schema("value string").load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def records(lines: DataFrame, feed: str | Feed, keep: Sequence[str] = ()) -> DataFrame:
    """Typed records of a feed's lines; malformed lines are left out.

    Numbers may come as numbers or as text, as change records send them.  A value that does not fit its type
    reads as null, and the record stays.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    scalar = lambda t: not isinstance(t, (T.StructType, T.ArrayType, T.MapType))
    as_text = T.StructType([T.StructField(f.name, T.StringType() if scalar(f.dataType) else f.dataType) for f in feed.schema])
    rows = parse_clean(lines, as_text, keep=keep)
    typed = [
        F.col(f.name).try_cast(f.dataType).alias(f.name) if scalar(f.dataType) and f.dataType != T.StringType() else F.col(f.name)
        for f in feed.schema
    ]
    return rows.select(*typed, *keep)


def register(lines: DataFrame, feed: str | Feed, view: str | None = None) -> DataFrame:
    """Records of a feed as a temporary view, for SQL."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    rows = records(lines, feed)
    rows.createOrReplaceTempView(view or feed.name)
    return rows
