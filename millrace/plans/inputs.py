"""The shop's records, expressed over the test tables.

Every frame covers its whole table.  ``EVENT_SQL`` and the other SQL fragments
say the same for the SQL side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-01"


class Tables:
    """Test tables of one folder and the shop records derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        # Event times are stored without a zone and mean UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        # Opening a file reads its schema; once per table is enough.
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def events(self) -> DataFrame:
        """Events with ``k`` (number in the properties) and ``ms`` (epoch milliseconds)."""
        return self.table("events").select(
            "event_id", "user_id", "event_type", "value", "props",
            F.get_json_object("props", "$.k").cast("long").alias("k"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        )

    # -- logs --

    def log_lines(self) -> DataFrame:
        """Raw log lines: start, page and malformed ones, as ``value``."""
        kind, k = F.col("event_type"), F.col("k")
        text = lambda c: F.col(c).cast("string")
        of = lambda value, *kinds: F.when(kind.isin(*kinds), value)
        item = lambda i, t: F.struct(i.cast("string").alias("item"), F.lit(t).alias("item_type"))
        page = F.struct(
            F.when(kind == "view", "home").when(kind == "click", "good_detail").otherwise("trade").alias("page_id"),
            F.when(kind == "click", "good_list").when(kind == "purchase", "good_detail")
            .when(k >= 25, "").alias("last_page_id"),
            of(k.cast("string"), "click").alias("item"),
            of(F.lit("sku_id"), "click").alias("item_type"),
            F.floor("value").cast("string").alias("during_time"),
        )
        record = F.struct(
            text("event_id").alias("log_id"),
            F.struct(
                text("user_id").alias("mid"),
                F.when(k < 33, "v1").otherwise("v2").alias("vc"),
                F.when(k < 50, "web").otherwise("app").alias("ch"),
                F.when(F.col("value") < 50, "north").otherwise("south").alias("ar"),
                F.when((kind == "signup") | ((kind == "view") & (k < 50)), "1").otherwise("0").alias("is_new"),
            ).alias("common"),
            of(page, "view", "click", "purchase").alias("page"),
            of(F.struct(F.lit("icon").alias("entry")), "signup").alias("start"),
            of(F.array(item(k, "sku_id"), item(k + 1, "activity_id")), "click").alias("displays"),
            F.col("ms").alias("ts"),
        )
        number = text("event_id")
        broken = (
            F.when(k % 5 == 1, F.concat(F.lit('{"log_id":"'), number, F.lit('"} tail')))
            .when(k % 5 == 2, F.concat(F.lit('{"log_id":"'), number, F.lit('"}{"log_id":"0"}')))
            .when(k % 5 == 3, F.concat(F.lit("{'log_id':'"), number, F.lit("'}")))
            .otherwise(F.concat(F.lit("error at "), number)))
        line = F.when(kind == "error", broken).otherwise(F.to_json(record))
        return self.events().select(line.alias("value"))

    def startup_logs(self) -> DataFrame:
        """Every event taken as a start-up log of the device."""
        return self.events().select(
            F.col("event_id").alias("log_id"), F.col("user_id").alias("mid"),
            F.col("event_type").alias("ch"), F.col("ms").alias("ts"),
        )

    def device_events(self) -> DataFrame:
        """Event logs: a purchase takes a coupon, a click browses an item."""
        kind = F.col("event_type")
        return self.events().select(
            F.col("user_id").cast("string").alias("mid"),
            F.round(F.col("value") * 100).cast("long").cast("string").alias("uid"),
            F.when(kind == "purchase", "coupon").when(kind == "click", "clickItem").otherwise(kind).alias("evid"),
            F.col("k").cast("string").alias("itemid"),
            F.col("ms").alias("ts"),
        )

    def search_pages(self) -> DataFrame:
        """Search result pages: each order line searched for its part's name when shipped."""
        parts = self.table("part").select("p_partkey", "p_name")
        lines = self.table("lineitem").select("l_partkey", "l_shipdate")
        return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
            F.struct(
                F.lit("search").alias("last_page_id"), F.lit("keyword").alias("item_type"),
                F.col("p_name").alias("item"),
            ).alias("page"),
            F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts"),
        )

    # -- changes --

    def _change_fields(self) -> DataFrame:
        kind, k = F.col("event_type"), F.col("k")
        text = lambda c: F.col(c).cast("string")
        return self.events().select(
            F.col("event_id").alias("seq"),
            F.when(kind == "purchase", "order_info").when(kind == "click", "order_detail")
            .when(kind == "error", "coupon_use").otherwise("user_info").alias("tableName"),
            F.when(kind.isin("purchase", "signup"), "create").when(kind == "error", "read")
            .when(k < 50, "update").otherwise("delete").alias("op"),
            F.create_map(
                F.lit("id"), text("event_id"), F.lit("user_id"), text("user_id"), F.lit("k"), text("k"),
            ).alias("image"),
            F.create_map(F.lit("id"), text("event_id")).alias("key"),
        )

    def connect_records(self) -> DataFrame:
        """Connector output: topic ``server.database.table`` and the envelope."""
        op = F.col("op")
        envelope = F.struct(
            F.upper("op").alias("op"),
            F.when(op.isin("update", "delete"), F.col("key")).alias("before"),
            F.when(op != "delete", F.col("image")).alias("after"),
        )
        return self._change_fields().select(
            F.concat(F.lit("source.shop."), "tableName").alias("topic"), F.to_json(envelope).alias("value")
        )

    def change_lines(self) -> DataFrame:
        """Change records as JSON lines; reads carry no image, some lines are cut off."""
        op = F.col("op")
        record = F.struct(
            F.lit("shop").alias("database"), "tableName",
            F.when(op == "create", "insert").otherwise(op).alias("type"),
            F.when(op == "delete", F.create_map().cast("map<string,string>"))
            .when(op != "read", F.col("image")).alias("data"),
            F.when(op.isin("update", "delete"), F.col("key")).alias("before"),
        )
        line = F.to_json(record)
        broken = (op == "update") & (F.col("image")["k"] == "7")
        return self._change_fields().select(
            F.when(broken, F.substring(line, 1, 30)).otherwise(line).alias("value")
        )

    def routes(self) -> DataFrame:
        """The routing table (fixed configuration)."""
        return self.spark.sql(f"SELECT * FROM VALUES {ROUTE_ROWS} AS t({ROUTE_NAMES})")

    # -- orders --

    def orders(self) -> DataFrame:
        status = F.col("o_orderstatus")
        money = F.col("o_totalprice").cast("decimal(16,2)")
        none = F.lit(None)
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"), none.cast("long").alias("province_id"),
            F.when(status == "O", "1001").when(status == "P", "1002").when(status == "F", "1004").alias("order_status"),
            F.col("o_custkey").alias("user_id"), money.alias("total_amount"),
            *[none.cast("decimal(16,2)").alias(n) for n in ("activity_reduce_amount", "coupon_reduce_amount")],
            money.alias("original_total_amount"), none.cast("decimal(16,2)").alias("feight_fee"),
            none.cast("string").alias("expire_time"),
            F.col("o_orderdate").cast("timestamp").alias("create_time"),
            none.cast("string").alias("operate_time"),
        )

    def details(self) -> DataFrame:
        none = F.lit(None)
        price = F.col("l_extendedprice").cast("decimal(16,2)")
        return self.table("lineitem").select(
            F.col("l_linenumber").cast("long").alias("id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"), price.alias("order_price"),
            F.col("l_quantity").cast("long").alias("sku_num"), F.col("l_returnflag").alias("sku_name"),
            F.col("l_shipdate").cast("timestamp").alias("create_time"),
            price.alias("split_total_amount"),
            *[none.cast("decimal(16,2)").alias(n) for n in ("split_activity_amount", "split_coupon_amount")],
        )

    def sale_orders(self) -> DataFrame:
        """Orders as the change-data job sees them, with day and hour."""
        time = F.col("o_orderdate").cast("timestamp")
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderstatus").alias("order_status"), F.col("o_totalprice").alias("total_amount"),
            F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        )

    def sale_lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_linenumber").alias("id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"), F.col("l_returnflag").alias("sku_name"),
            F.col("l_extendedprice").cast("decimal(16,2)").alias("order_price"),
        )

    # -- dimensions --

    def dims(self) -> Mapping[str, DataFrame]:
        """The dimensions by name, each one built when it is asked for."""
        return _Dims(self)

    def dim_user(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("ID"), F.col("c_nationkey").alias("PROVINCE_ID"),
            F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"), "F").otherwise("M").alias("GENDER"),
            F.date_add(F.lit("1950-01-01").cast("date"), F.floor("c_acctbal").cast("int")).alias("BIRTHDAY"),
            F.col("c_mktsegment").alias("LEVEL"),
        )

    def dim_province(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("ID"), F.col("n_name").alias("NAME"),
            F.col("n_regionkey").cast("string").alias("AREA_CODE"),
            F.concat(F.lit("N"), "n_nationkey").alias("ISO_CODE"),
            F.concat(F.lit("R"), "n_regionkey", F.lit("-"), "n_nationkey").alias("ISO_3166_2"),
        )

    def dim_sku(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("ID"), F.col("p_name").alias("SKU_NAME"),
            F.col("p_retailprice").cast("decimal(16,2)").alias("PRICE"),
            F.col("p_type").alias("SPU_ID"), F.col("p_brand").alias("TM_ID"),
            F.col("p_size").alias("CATEGORY3_ID"),
        )

    def dim_spu(self) -> DataFrame:
        return self.table("part").groupBy(F.col("p_type").alias("ID")).agg(F.min("p_name").alias("SPU_NAME"))

    def dim_trademark(self) -> DataFrame:
        return self.table("part").groupBy(F.col("p_brand").alias("ID")).agg(F.max("p_name").alias("TM_NAME"))

    def dim_category3(self) -> DataFrame:
        return self.table("part").groupBy(F.col("p_size").alias("ID")).agg(F.min("p_brand").alias("NAME"))

    def dim_supplier(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("ID"), F.col("s_name").alias("NAME"), F.col("s_nationkey").alias("NATION_ID")
        )

    def dim_nation(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("ID"), F.col("n_name").alias("NAME"), F.col("n_regionkey").alias("REGION_ID")
        )

    def dim_region(self) -> DataFrame:
        return self.table("region").select(F.col("r_regionkey").alias("ID"), F.col("r_name").alias("NAME"))

    def users(self) -> DataFrame:
        return self.dim_user().select(
            F.col("ID").alias("id"), F.col("GENDER").alias("gender"), F.col("BIRTHDAY").alias("birthday"),
            F.col("LEVEL").alias("user_level"),
        )


class _Dims(dict):
    def __init__(self, tables: Tables):
        self._tables = tables

    def __missing__(self, name: str) -> DataFrame:
        self[name] = frame = getattr(self._tables, f"dim_{name}")()
        return frame


# Fixed configuration of the routing table.
ROUTE_NAMES = "sourceTable, operateType, sinkType, sinkTable, sinkColumns, sinkPk, sinkExtend"
ROUTE_ROWS = """
    ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id,user_id', CAST(NULL AS STRING), CAST(NULL AS STRING)),
    ('order_detail', 'update', 'kafka', 'dwd_order_detail', 'id,k', 'id', ''),
    ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,k,missing', 'id', 'salted'),
    ('user_info', 'update', 'hbase', 'dim_user_info', 'user_id', CAST(NULL AS STRING), CAST(NULL AS STRING)),
    ('order_detail', 'delete', 'clickhouse', 'stats', 'id', 'id', '')
"""

E_SQL = """e AS (
    SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           epoch_us(ts) // 1000 AS ms
    FROM events)"""

LOGS_SQL = E_SQL + """, logs AS (
    SELECT CAST(event_id AS VARCHAR) AS log_id, CAST(user_id AS VARCHAR) AS mid,
           CASE WHEN k < 33 THEN 'v1' ELSE 'v2' END AS vc, CASE WHEN k < 50 THEN 'web' ELSE 'app' END AS ch,
           CASE WHEN value < 50 THEN 'north' ELSE 'south' END AS ar,
           CASE WHEN event_type = 'signup' OR (event_type = 'view' AND k < 50) THEN '1' ELSE '0' END AS is_new,
           CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'trade' END
               AS page_id,
           CASE event_type WHEN 'click' THEN 'good_list' WHEN 'purchase' THEN 'good_detail'
               WHEN 'view' THEN CASE WHEN k >= 25 THEN '' END END AS last_page_id,
           CASE WHEN event_type = 'click' THEN CAST(k AS VARCHAR) END AS item,
           CASE WHEN event_type = 'click' THEN 'sku_id' END AS item_type,
           CASE WHEN event_type <> 'signup' THEN CAST(floor(value) AS BIGINT) END AS during_time,
           event_type = 'signup' AS is_start, ms AS ts, k
    FROM e WHERE event_type <> 'error')"""

PAGES_SQL = LOGS_SQL + """, pages AS (SELECT * FROM logs WHERE NOT is_start)"""

CHANGES_SQL = E_SQL + """, changes AS (
    SELECT event_id AS seq, CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
           CAST(k AS VARCHAR) AS k,
           CASE event_type WHEN 'purchase' THEN 'order_info' WHEN 'click' THEN 'order_detail'
               WHEN 'error' THEN 'coupon_use' ELSE 'user_info' END AS "tableName",
           CASE WHEN event_type IN ('purchase', 'signup') THEN 'insert' WHEN event_type = 'error' THEN 'read'
               WHEN k < 50 THEN 'update' ELSE 'delete' END AS "type"
    FROM e)"""

KEPT_SQL = CHANGES_SQL + """, kept AS (
    SELECT * FROM changes WHERE "type" <> 'read' AND NOT ("type" = 'update' AND k = '7'))"""

DAU_SQL = E_SQL + """, dau AS (
    SELECT event_id AS log_id, user_id AS mid, event_type AS ch, ms AS ts,
           strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS "logDate",
           strftime(make_timestamp(ms * 1000), '%H') AS "logHour"
    FROM e
    QUALIFY row_number() OVER (PARTITION BY user_id, "logDate" ORDER BY ms, event_id) = 1)"""

USER_SQL = """users AS (
    SELECT c_custkey AS uid, c_nationkey AS province,
           CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'F' ELSE 'M' END AS user_gender,
           CAST(floor(date_diff('day', DATE '1950-01-01' + CAST(floor(c_acctbal) AS INTEGER), DATE '2024-01-01') / 365)
               AS BIGINT) AS user_age,
           c_mktsegment AS user_level
    FROM customer)"""

DIMS_SQL = USER_SQL + """, provinces AS (
    SELECT n_nationkey AS province_id, n_name AS province_name, CAST(n_regionkey AS VARCHAR) AS province_area_code,
           'N' || n_nationkey AS province_iso_code,
           'R' || n_regionkey || '-' || n_nationkey AS province_3166_2_code
    FROM nation), spus AS (SELECT p_type AS spu_id, min(p_name) AS spu_name FROM part GROUP BY 1),
    trademarks AS (SELECT p_brand AS tm_id, max(p_name) AS tm_name FROM part GROUP BY 1),
    categories AS (SELECT p_size AS category3_id, min(p_brand) AS category3_name FROM part GROUP BY 1)"""
