"""Message sinks: rows to topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGE_ID = "message_id"


def kafka_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Sink options; leave ``topic`` out when the rows carry a topic column."""
    options = {"kafka.bootstrap.servers": servers, "kafka.enable.idempotence": "true", "kafka.acks": "all"}
    return {**options, "topic": topic} if topic else options


def messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Whole rows as JSON text in ``value``."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def routed_messages(routed: DataFrame) -> DataFrame:
    """Routed changes: topic from the route, payload is the pruned row.

    A column ``message_id``, the place of the change in its source, goes along: a batch that is sent again sends the same ids.
    """
    given = [MESSAGE_ID] if MESSAGE_ID in routed.columns else []
    return routed.select(F.col("sinkTable").alias("topic"), F.to_json("data").alias("value"), *given)


def with_headers(sent: DataFrame) -> DataFrame:
    """``message_id`` as a header, as the Kafka sink takes it (write with ``includeHeaders``)."""
    header = F.struct(F.lit(MESSAGE_ID).alias("key"), F.col(MESSAGE_ID).cast("binary").alias("value"))
    return sent.withColumn("headers", F.array(header)).drop(MESSAGE_ID)


def message_id_of(headers: Column) -> Column:
    """The id among a message's headers; null if it has none."""
    return F.try_element_at(F.filter(headers, lambda h: h["key"] == MESSAGE_ID), F.lit(1))["value"].cast("string")


def once(messages: DataFrame, delay: str = "1 hour", time: str = "timestamp") -> DataFrame:
    """The messages of a stream without those whose ``message_id`` came before, less than ``delay`` ago.

    A message without an id is never taken for a repeated one.
    """
    unnamed = F.when(F.col(MESSAGE_ID).isNull(), F.expr("uuid()"))
    rows = messages.withColumn("_unnamed", unnamed).withWatermark(time, delay)
    return rows.dropDuplicatesWithinWatermark([MESSAGE_ID, "_unnamed"]).drop("_unnamed")
