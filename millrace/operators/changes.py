"""Database change records: decoding, static and configured routing, pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.latest import latest_by_key
from millrace.operators.logs import parse_clean
from millrace.schemas import CHANGE, CONNECT_VALUE, ROUTE, TEXT_MAP

FACT_SINK, DIM_SINK = "kafka", "hbase"

# Which changes the forwarder passes on, and where to.
STATIC_ROUTES = {
    "order_info": (("insert",), "order_info"),
    "order_detail": (("insert",), "order_detail"),
    "user_info": (("insert", "update"), "user_info"),
}


# The connector's operation codes and names.
OPERATIONS = {"c": "insert", "create": "insert", "u": "update", "d": "delete", "r": "read"}


def decode_connect(
    records: DataFrame, topic: str = "topic", value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Connector records (topic ``server.database.table``) to change records, with the columns named in ``keep``.

    Operation codes and names become the change's type; an unknown one is passed on as it is.  Values that are
    not JSON objects are dropped.
    """
    path = records.withColumn("_path", F.split(topic, r"\."))
    rows = parse_clean(path, CONNECT_VALUE, value, ["_path", *keep]).withColumnRenamed("_path", "path")
    names = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    # a known code as it stands needs no lower-casing
    kind = F.coalesce(F.try_element_at(names, "op"), F.try_element_at(names, F.lower("op")), F.lower("op"))
    empty = F.create_map().cast(TEXT_MAP)
    return rows.select(
        F.try_element_at("path", F.lit(2)).alias("database"),
        F.try_element_at("path", F.lit(3)).alias("tableName"),
        kind.alias("type"),
        F.coalesce("after", empty).alias("data"),
        F.coalesce("before", empty).alias("before"),
        *keep,
    )


def parse_changes(lines: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Change records from JSON lines, with the columns named in ``keep``; malformed lines are dropped."""
    return parse_clean(lines, CHANGE, value, keep)


def with_after_image(changes: DataFrame) -> DataFrame:
    """Changes that carry a ``data`` object; the empty object of a delete passes."""
    return changes.where(F.col("data").isNotNull())


def route_static(changes: DataFrame, routes: dict = STATIC_ROUTES) -> DataFrame:
    """Topic and payload (after image as JSON text) of the forwarded changes."""
    topic: Column = F.lit(None).cast("string")
    for table, (operations, target) in routes.items():
        hit = (F.col("tableName") == table) & F.lower("type").isin(*operations)
        topic = F.when(hit, target).otherwise(topic)
    return (
        changes.withColumn("topic", topic)
        .where(F.col("topic").isNotNull())
        .select("topic", F.to_json("data").alias("value"), "data")
    )


def current_routes(config_changes: DataFrame, order: str = "seq") -> DataFrame:
    """Routing table now in force: the latest row per (table, operation), unless deleted.

    ``config_changes`` holds change records of the routing table and an ordering
    column.  A delete is keyed by its before image.
    """
    image = F.when(F.col("type") == "delete", F.col("before")).otherwise(F.col("data"))
    rows = config_changes.select(
        *[F.try_element_at(image, F.lit(name)).alias(name) for name in ROUTE.names], "type", order
    )
    latest = latest_by_key(rows, ["sourceTable", "operateType"], [order])
    return latest.where(F.col("type") != "delete").select(*ROUTE.names)


def prune(data: Column | str, columns: Column | str) -> Column:
    """Keep the map entries named in a comma list (exact names, not trimmed)."""
    data = F.col(data) if isinstance(data, str) else data
    columns = F.col(columns) if isinstance(columns, str) else columns
    return _kept(data, F.split(columns, ","))


def _kept(data: Column, wanted: Column) -> Column:
    return F.map_filter(data, lambda name, _: F.array_contains(wanted, name))


def route_by_config(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Send each change where the routing table says, with its columns pruned.

    Rows without a route, or routed to a sink that is neither the fact nor the
    dimension sink, are dropped.  The routing table is a few rows and is joined
    by whatever means Spark picks from its size.
    """
    wanted = routes.where(F.col("sinkType").isin(FACT_SINK, DIM_SINK)).select(
        F.col("sourceTable").alias("tableName"),
        F.col("operateType").alias("type"),
        "sinkType",
        "sinkTable",
        F.split("sinkColumns", ",").alias("_wanted"),  # once a route, not once an entry
        F.coalesce("sinkPk", F.lit("id")).alias("sinkPk"),
        F.coalesce("sinkExtend", F.lit("")).alias("sinkExtend"),
    )
    routed = changes.join(wanted, ["tableName", "type"], "inner")
    return routed.withColumn("data", _kept(F.col("data"), F.col("_wanted"))).drop("_wanted")


def facts(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sinkType") == FACT_SINK)


def dims(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sinkType") == DIM_SINK)


def dim_schema(columns: str, key: str | None) -> T.StructType:
    """All-text schema of a configured dimension table; the key is not null."""
    key = key or "id"
    return T.StructType(
        [T.StructField(name, T.StringType(), name != key) for name in columns.split(",")]
    )
