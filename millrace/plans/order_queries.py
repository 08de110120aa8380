"""Orders, payments, dimension joins, product and province statistics, search."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from millrace.functions.codes import code_label
from millrace.functions.moments import from_millis_whole_seconds
from millrace.functions.text import tokenize as words_of
from millrace.operators import changes, joins, orders, reports, search, sql_stats, stats, words
from millrace.operators.joins import DimSpec, enrich
from millrace.plans.inputs import AS_OF, DIMS_SQL, PAGES_SQL, ROUTE_NAMES, USER_SQL, Tables
from millrace.plans.registry import SQL, query
from millrace.plans.visit_queries import _pages
from millrace.schemas import PRODUCT_STATS_COLUMNS, PROVINCE_STATS_COLUMNS
from millrace.sinks.kafka import routed_messages
from millrace.sources.feeds import records
from millrace.streaming import jobs

# Order and ship dates are midnights, so the bounds are days instead of seconds.
_BOUNDS = {"lower": timedelta(days=-5), "upper": timedelta(days=5)}
_PAY_BOUNDS = {"lower": timedelta(days=-15), "upper": timedelta(days=5)}
_DATE = "%Y-%m-%d %H:%M:%S"
_MONEY = "CAST(l_extendedprice AS DECIMAL(16,2))"
_STATUS_SQL = "CASE o_orderstatus WHEN 'O' THEN '1001' WHEN 'P' THEN '1002' WHEN 'F' THEN '1004' END"
_NEAR_SQL = "l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 5 DAY"


def _wide(t: Tables):
    return orders.order_wide(t.orders(), t.details(), **_BOUNDS)


@query("order_wide_interval_join", f"""
    SELECT CAST(l_linenumber AS BIGINT) AS detail_id, o_orderkey AS order_id, l_partkey AS sku_id,
           CAST({_MONEY} AS DOUBLE) AS split_total_amount, {_STATUS_SQL} AS order_status, o_custkey AS user_id,
           o_totalprice AS total_amount, strftime(o_orderdate, '{_DATE}') AS create_time,
           strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND {_NEAR_SQL}""")
def order_wide_interval_join(t: Tables):
    return _wide(t).select(
        "detail_id", "order_id", "sku_id", "split_total_amount", "order_status", "user_id", "total_amount",
        "create_time", "create_date", "create_hour",
    )


def _order_dims() -> list[DimSpec]:
    # The test orders know their province only through the customer.
    user, province, *products = joins.order_dims(AS_OF)
    user = DimSpec(user.table, user.fact_key, {**user.take, "province_id": "PROVINCE_ID"})
    return [user, province, *products]


def _enriched(t: Tables):
    return enrich(_wide(t).drop("province_id"), t.dims(), _order_dims())


_WIDE_SQL = f"""
    SELECT CAST(l_linenumber AS BIGINT) AS detail_id, o_orderkey AS order_id, l_partkey AS sku_id,
           CAST({_MONEY} AS DOUBLE) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num, l_returnflag AS sku_name,
           CAST(province AS BIGINT) AS province_id, {_STATUS_SQL} AS order_status, o_custkey AS user_id,
           o_totalprice AS total_amount, o_totalprice AS original_total_amount,
           CAST({_MONEY} AS DOUBLE) AS split_total_amount, strftime(o_orderdate, '{_DATE}') AS create_time,
           strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour,
           province_name, province_area_code, province_iso_code, province_3166_2_code, user_age, user_gender,
           spu_id, tm_id, CAST(p_size AS BIGINT) AS category3_id, spu_name, tm_name, category3_name
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND {_NEAR_SQL}
    JOIN users ON uid = o_custkey JOIN provinces ON province_id = province
    JOIN part ON p_partkey = l_partkey JOIN spus ON spu_id = p_type JOIN trademarks ON tm_id = p_brand
    JOIN categories ON category3_id = p_size"""

# Columns the test tables have no source for.
_UNSOURCED = [
    "activity_reduce_amount", "coupon_reduce_amount", "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "expire_time", "operate_time",
]


@query("order_wide", f"WITH {DIMS_SQL} {_WIDE_SQL}")
def order_wide(t: Tables):
    return orders.order_wide_table(_enriched(t)).drop(*_UNSOURCED)


def _payments(t: Tables):
    """Each order's payment, made when the order was placed."""
    return t.table("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(16,2)").alias("total_amount"),
        F.col("o_orderpriority").alias("subject"), F.lit("1101").alias("payment_type"),
        F.col("o_orderdate").cast("timestamp").alias("create_time"), F.lit(None).cast("string").alias("callback_time"),
    )


def _line_wide(t: Tables):
    """Order lines as wide order rows, created when shipped."""
    return t.details().select(
        F.col("id").alias("detail_id"), "order_id", "sku_id", "sku_num", "split_total_amount", "create_time",
        F.lit(None).cast("long").alias("user_id"), F.lit(None).cast("decimal(16,2)").alias("total_amount"),
    )


@query("payment_wide_interval_join", f"""
    SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_custkey AS user_id, o_totalprice AS total_amount,
           o_orderpriority AS subject, strftime(o_orderdate, '{_DATE}') AS payment_create_time,
           CAST(l_linenumber AS BIGINT) AS detail_id, l_partkey AS sku_id,
           CAST({_MONEY} AS DOUBLE) AS split_total_amount, strftime(l_shipdate, '{_DATE}') AS order_create_time
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
     AND l_shipdate BETWEEN o_orderdate - INTERVAL 15 DAY AND o_orderdate + INTERVAL 5 DAY""")
def payment_wide_interval_join(t: Tables):
    paid = orders.payment_wide(_payments(t), _line_wide(t).withColumns({
        n: F.lit(None).cast("string") for n in ("create_date", "create_hour", "expire_time", "operate_time")
    }), **_PAY_BOUNDS)
    return paid.select(
        "payment_id", "order_id", "user_id", "total_amount", "subject", "payment_create_time", "detail_id", "sku_id",
        "split_total_amount", "order_create_time",
    )


@query("order_detail_full_outer", """
    SELECT o_orderkey, o_orderstatus, l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CASE WHEN l_orderkey IS NULL THEN 'left_only' WHEN o_orderkey IS NULL THEN 'right_only' ELSE 'matched' END
               AS branch
    FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey""")
def order_detail_full_outer(t: Tables):
    left = t.table("orders").select("o_orderkey", "o_orderstatus")
    right = t.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    joined = joins.full_outer_join(left, right, "o_orderkey", "l_orderkey")
    return joined.withColumn("branch", joins.join_branch("o_orderkey", "l_orderkey"))


def _sales(t: Tables):
    return joins.sale_details(orders.with_create_parts(t.sale_orders()), t.sale_lines())


_SALE_SQL = f"""
    SELECT CAST(l_linenumber AS BIGINT) AS order_detail_id, o_orderkey AS order_id, o_orderstatus AS order_status,
           strftime(o_orderdate, '{_DATE}') AS create_time, o_custkey AS user_id, l_partkey AS sku_id,
           CAST({_MONEY} AS DOUBLE) AS sku_price, l_returnflag AS sku_name,
           strftime(o_orderdate, '%Y-%m-%d') AS dt
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""


@query("sale_detail", _SALE_SQL)
def sale_detail(t: Tables):
    return _sales(t).select(
        "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "sku_price", "sku_name",
        "dt",
    )


@query("sale_detail_user_left", f"""
    WITH {USER_SQL}
    SELECT s.*, user_gender, coalesce(user_age, 0) AS user_age, user_level
    FROM ({_SALE_SQL}) AS s LEFT JOIN users ON uid = user_id""")
def sale_detail_user_left(t: Tables):
    return joins.with_sale_user(_sales(t), t.users(), AS_OF)


def _order_facts(t: Tables):
    return t.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))


def _line_facts(t: Tables):
    return t.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("sku_id"),
        F.col("l_suppkey").alias("supplier_id"),
    )


@query("dim_join_user", f"""
    WITH {USER_SQL}
    SELECT o_orderkey AS order_id, o_custkey AS user_id, user_age, user_gender, CAST(province AS BIGINT) AS province_id
    FROM orders JOIN users ON uid = o_custkey""")
def dim_join_user(t: Tables):
    return enrich(_order_facts(t), t.dims(), _order_dims()[:1])


@query("dim_join_province", f"""
    WITH {DIMS_SQL}
    SELECT o_orderkey AS order_id, CAST(province_id AS BIGINT) AS province_id, province_name, province_area_code,
           province_iso_code, province_3166_2_code
    FROM orders JOIN users ON uid = o_custkey JOIN provinces ON province_id = province""")
def dim_join_province(t: Tables):
    return enrich(_order_facts(t), t.dims(), _order_dims()[:2]).select(
        "order_id", "province_id", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code"
    )


@query("dim_join_sku", """
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS sku_id, l_suppkey AS supplier_id,
           p_type AS spu_id, p_brand AS tm_id, CAST(p_size AS BIGINT) AS category3_id
    FROM lineitem JOIN part ON p_partkey = l_partkey""")
def dim_join_sku(t: Tables):
    return enrich(_line_facts(t), t.dims(), [_order_dims()[2]])


@query("dim_join_snowflake", f"""
    WITH {DIMS_SQL}
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS sku_id,
           spu_name, tm_name, category3_name, s_name AS supplier, n_name AS nation, r_name AS region
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN spus ON spu_id = p_type
    JOIN trademarks ON tm_id = p_brand JOIN categories ON category3_id = p_size
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey""")
def dim_join_snowflake(t: Tables):
    places = [
        DimSpec("supplier", "supplier_id", {"supplier": "NAME", "nation_id": "NATION_ID"}),
        DimSpec("nation", "nation_id", {"nation": "NAME", "region_id": "REGION_ID"}),
        DimSpec("region", "region_id", {"region": "NAME"}),
    ]
    return enrich(_line_facts(t), t.dims(), _order_dims()[2:] + places).select(
        "order_id", "line", "sku_id", "spu_name", "tm_name", "category3_name", "supplier", "nation", "region"
    )


def _bucket(time: str, extra: str = "") -> str:
    return f"strftime(time_bucket(INTERVAL 30 DAY, {time}, TIMESTAMP '1970-01-01'){extra}, '{_DATE}')"


def province_orders(t: Tables):
    """Every order that has lines, with the sum of them and its province id (no time bound).

    The lines are summed per order before the joins; the order key's partitioning
    then serves the join and the count of distinct orders as well.
    """
    amounts = t.details().groupBy("order_id").agg(F.sum("split_total_amount").alias("split_total_amount"))
    order = t.orders().select(F.col("id").alias("_order"), "user_id", "create_time")
    wide = amounts.join(order, F.col("order_id") == F.col("_order")).drop("_order")
    user = DimSpec("user", "user_id", {"province_id": "PROVINCE_ID"})
    return enrich(wide, t.dims(), [user])


@query("province_stats", f"""
    WITH {DIMS_SQL}
    SELECT {_bucket('o_orderdate')} AS stt, {_bucket('o_orderdate', ' + INTERVAL 30 DAY')} AS edt,
           CAST(province_id AS BIGINT) AS province_id, province_name, province_area_code, province_iso_code,
           province_3166_2_code, CAST(sum({_MONEY}) AS DOUBLE) AS order_amount,
           count(DISTINCT o_orderkey) AS order_count, epoch_us(max(o_orderdate)) // 1000 AS ts
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN users ON uid = o_custkey
    JOIN provinces ON province_id = province
    GROUP BY ALL""")
def province_stats(t: Tables):
    # The province names are joined to the finished rows, not to every line.
    rows = stats.province_stats(province_orders(t), "30 days", keys=["province_id"])
    return enrich(rows, t.dims(), [_order_dims()[1]]).select(*PROVINCE_STATS_COLUMNS)


def product_sources(t: Tables) -> list:
    """The seven product sources, from page records and order lines; a table is read once for all rows it gives."""
    pages, kind = _pages(t), F.col("event_type")
    touched = t.events().where(kind.isin("view", "purchase")).select(
        F.col("k").alias("sku_id"), F.timestamp_millis("ms").alias("create_time"), F.when(kind == "view", "favor").otherwise("cart").alias("touch"))
    order = t.orders().select(F.col("id").alias("_order"), F.col("create_time").alias("placed"))
    placed = t.details().join(order, F.col("order_id") == F.col("_order")).withColumn("create_time", F.col("placed"))
    price = F.col("l_extendedprice").cast("decimal(16,2)")
    shipped = stats.rows_in_one_pass(
        t.table("lineitem"), "l_partkey", F.col("l_shipdate").cast("timestamp"), "l_orderkey", [
            ("payment", None, None, price), ("refund", F.col("l_returnflag") == "R", None, price),
            ("comment", None, F.when(F.col("l_linestatus") == "F", 1).otherwise(0), None)])
    return [
        stats.page_rows(pages), stats.product_rows(touched, F.col("touch"), "sku_id", F.col("create_time")), stats.order_rows(placed), shipped,
    ]


_PRODUCT_SQL = f"""
    WITH {PAGES_SQL}, {DIMS_SQL}, rows AS (
        SELECT CAST(item AS BIGINT) AS sku_id, make_timestamp(ts * 1000) AS et, 'click' AS kind,
               NULL::BIGINT AS oid, 0 AS num, 0::DECIMAL(16,2) AS amount, 0 AS good FROM pages WHERE item IS NOT NULL
        UNION ALL
        SELECT CAST(item AS BIGINT), make_timestamp(ts * 1000), 'display', NULL, 0, 0, 0
        FROM pages WHERE item IS NOT NULL
        UNION ALL
        SELECT k, make_timestamp(ms * 1000), CASE event_type WHEN 'view' THEN 'favor' ELSE 'cart' END, NULL, 0, 0, 0
        FROM e WHERE event_type IN ('view', 'purchase')
        UNION ALL
        SELECT l_partkey, o_orderdate, 'order', l_orderkey, CAST(l_quantity AS BIGINT), {_MONEY}, 0
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        UNION ALL
        SELECT l_partkey, l_shipdate, 'paid', l_orderkey, 0, {_MONEY}, 0 FROM lineitem
        UNION ALL
        SELECT l_partkey, l_shipdate, 'refund', l_orderkey, 0, {_MONEY}, 0 FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL
        SELECT l_partkey, l_shipdate, 'comment', NULL, 0, 0, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END
        FROM lineitem), agg AS (
    SELECT {_bucket('et')} AS stt, {_bucket('et', ' + INTERVAL 30 DAY')} AS edt, sku_id,
           count(CASE WHEN kind = 'display' THEN 1 END) AS display_ct,
           count(CASE WHEN kind = 'click' THEN 1 END) AS click_ct,
           count(CASE WHEN kind = 'favor' THEN 1 END) AS favor_ct,
           count(CASE WHEN kind = 'cart' THEN 1 END) AS cart_ct, CAST(sum(num) AS BIGINT) AS order_sku_num,
           CAST(sum(CASE WHEN kind = 'order' THEN amount ELSE 0 END) AS DOUBLE) AS order_amount,
           count(DISTINCT CASE WHEN kind = 'order' THEN oid END) AS order_ct,
           CAST(sum(CASE WHEN kind = 'paid' THEN amount ELSE 0 END) AS DOUBLE) AS payment_amount,
           count(DISTINCT CASE WHEN kind = 'paid' THEN oid END) AS paid_order_ct,
           count(DISTINCT CASE WHEN kind = 'refund' THEN oid END) AS refund_order_ct,
           CAST(sum(CASE WHEN kind = 'refund' THEN amount ELSE 0 END) AS DOUBLE) AS refund_amount,
           count(CASE WHEN kind = 'comment' THEN 1 END) AS comment_ct, CAST(sum(good) AS BIGINT) AS good_comment_ct,
           epoch_us(max(et)) // 1000 AS ts
    FROM rows GROUP BY 1, 2, 3)
    SELECT stt, edt, sku_id, p_name AS sku_name, CAST(CAST(p_retailprice AS DECIMAL(16,2)) AS DOUBLE) AS sku_price,
           spu_id, spu_name, tm_id, tm_name, CAST(category3_id AS BIGINT) AS category3_id, category3_name,
           display_ct, click_ct, favor_ct, cart_ct, order_sku_num, order_amount, order_ct, payment_amount,
           paid_order_ct, refund_order_ct, refund_amount, comment_ct, good_comment_ct, ts
    FROM agg JOIN part ON p_partkey = sku_id JOIN spus ON spu_id = p_type JOIN trademarks ON tm_id = p_brand
    JOIN categories ON category3_id = p_size"""


@query("product_stats", _PRODUCT_SQL)
def product_stats(t: Tables):
    # Joined after the aggregation: one row per sku and window meets the dimensions.
    rows = stats.product_stats(product_sources(t), "30 days")
    return enrich(rows, t.dims(), joins.product_dims()).select(*PRODUCT_STATS_COLUMNS)


@query("keyword_stats", f"""
    SELECT keyword, count(*) AS ct, 'SEARCH' AS source, {_bucket('l_shipdate')} AS stt,
           {_bucket('l_shipdate', ' + INTERVAL 30 DAY')} AS edt, epoch_us(max(l_shipdate)) // 1000 AS ts
    FROM (SELECT l_shipdate, unnest(regexp_extract_all(lower(p_name), '[\\p{{L}}\\p{{N}}]+')) AS keyword
          FROM lineitem JOIN part ON p_partkey = l_partkey)
    GROUP BY ALL""")
def keyword_stats(t: Tables):
    return stats.keyword_stats(t.search_pages(), "30 days").select("keyword", "ct", "source", "stt", "edt", "ts")


def _with_view(t: Tables, df, statement):
    """A SQL statement over a view whose name nobody else has; it is resolved once and the view dropped."""
    view = f"rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        return statement(view)
    finally:
        t.spark.catalog.dropTempView(view)


@query("keyword_stats_sql", SQL["keyword_stats"])
def keyword_stats_sql(t: Tables):
    pages = t.search_pages().withColumn("event_time", from_millis_whole_seconds("ts"))
    return _with_view(t, pages, lambda view: sql_stats.keyword_stats(t.spark, view, "30 days"))


@query("province_stats_sql", SQL["province_stats"])
def province_stats_sql(t: Tables):
    wide = enrich(province_orders(t), t.dims(), [_order_dims()[1]])
    orders_at = wide.withColumnRenamed("create_time", "event_time")
    return _with_view(t, orders_at, lambda view: sql_stats.province_stats(t.spark, view, "30 days"))


@query("tokenize", """
    SELECT word, count(*) AS ct
    FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word FROM documents)
    GROUP BY 1""")
def tokenize(t: Tables):
    return t.table("documents").select(F.explode(words_of("text")).alias("word")).groupBy("word").agg(
        F.count("*").alias("ct")
    )


@query("gmv_enrich", f"""
    SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS order_status, o_totalprice AS total_amount,
           strftime(o_orderdate, '{_DATE}') AS create_time, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
           strftime(o_orderdate, '%H') AS create_hour
    FROM orders""")
def gmv_enrich(t: Tables):
    return orders.with_create_parts(t.sale_orders())


@query("gmv_by_hour", """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour,
           CAST(sum(CAST(o_totalprice AS DECIMAL(16,2))) AS DOUBLE) AS gmv, count(*) AS order_ct
    FROM orders GROUP BY 1, 2""")
def gmv_by_hour(t: Tables):
    return reports.gmv_by_hour(orders.with_create_parts(t.sale_orders()))


@query("code_label", f"""
    SELECT o_orderkey, {_STATUS_SQL} AS code,
           CASE o_orderstatus WHEN 'O' THEN 'unpaid' WHEN 'P' THEN 'paid' WHEN 'F' THEN 'finished' END AS label
    FROM orders""")
def code_label_query(t: Tables):
    return t.orders().select(
        F.col("id").alias("o_orderkey"), F.col("order_status").alias("code"),
        code_label("order_status", "order_status").alias("label"),
    )


@query("terms_topk_max", """
    SELECT l_partkey, count(*) AS doc_count, max(l_extendedprice) AS max_price FROM lineitem
    GROUP BY 1 ORDER BY doc_count DESC, l_partkey LIMIT 10""")
def terms_topk_max(t: Tables):
    rows = t.table("lineitem").select("l_partkey", "l_extendedprice")
    return search.top_terms(rows, "l_partkey", max_price=F.max("l_extendedprice"))


_QUERY = "Reading the nation"
_HITS_SQL = """hits AS (
    SELECT doc_id, source, n_chars,
           len(list_filter(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'),
                           lambda w: w IN ('reading', 'the', 'nation'))) AS score
    FROM documents WHERE lang = 'en' AND score > 0)"""


def _hits(t: Tables):
    docs = t.table("documents").select("doc_id", "source", "n_chars", "lang", "text")
    return search.search(docs, {"lang": "en"}, "text", _QUERY).drop("text", "lang")


@query("search_match", f"WITH {_HITS_SQL} SELECT doc_id, source, n_chars, score FROM hits")
def search_match(t: Tables):
    return _hits(t)


@query("search_total", f"WITH {_HITS_SQL} SELECT count(*) AS total FROM hits")
def search_total(t: Tables):
    return search.hit_total(_hits(t))


@query("search_page", f"""
    WITH {_HITS_SQL} SELECT doc_id, source, n_chars, score FROM hits ORDER BY score DESC, doc_id LIMIT 2 OFFSET 0""")
def search_page(t: Tables):
    return search.page_of(_hits(t), "doc_id", 2)


@query("search_terms", f"""
    WITH {_HITS_SQL}
    SELECT source, count(*) AS doc_count, max(n_chars) AS max_chars FROM hits
    GROUP BY 1 ORDER BY doc_count DESC, source LIMIT 10""")
def search_terms(t: Tables):
    # The buckets cover all hits, not only the page shown.
    return search.top_terms(_hits(t), "source", max_chars=F.max("n_chars"))


@query("tokenize_smart", r"""
    WITH RECURSIVE run AS MATERIALIZED (
        SELECT run, count(*) AS m FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS run FROM documents) GROUP BY 1),
    edge AS MATERIALIZED (
        SELECT run, i, list(n) AS ns
        FROM (SELECT run, i, unnest([2, 3, 4]) AS n FROM (SELECT run, unnest(range(0, length(run))) AS i FROM run))
        WHERE i + n <= length(run) AND substr(run, CAST(i + 1 AS INT), n) IN (SELECT run FROM run WHERE length(run) BETWEEN 2 AND 4) GROUP BY run, i),
    way AS (
        SELECT run, CAST(length(run) AS BIGINT) AS i, [CAST(1000000000 AS BIGINT)] AS best, CAST([] AS BIGINT[]) AS lens FROM run
        UNION ALL
        SELECT run, i, list_prepend(v - v % 1000, best), list_prepend(v % 1000, lens)
        FROM (
            SELECT way.run, way.i - 1 AS i, best, lens,
                list_max(list_prepend(best[1] - 1000000 + 1, list_transform(coalesce(ns, []), lambda n: best[n] + n * 1000000000000 - 1000000 + n))) AS v
            FROM way LEFT JOIN edge ON edge.run = way.run AND edge.i = way.i - 1 WHERE way.i > 0)),
    step AS (
        SELECT run, CAST(0 AS BIGINT) AS p, lens FROM way WHERE i = 0
        UNION ALL SELECT run, p + lens[p + 1], lens FROM step WHERE p < len(lens))
    SELECT substr(step.run, CAST(p + 1 AS INT), CAST(lens[p + 1] AS INT)) AS word, CAST(sum(m) AS BIGINT) AS ct
    FROM step JOIN run ON run.run = step.run WHERE p < len(lens) GROUP BY 1""")
def tokenize_smart(t: Tables):
    # The short runs of all documents are the dictionary, and any letter is a unit, so that words overlap everywhere.
    runs = words.run_counts(t.table("documents"), "text")
    short = runs.where(F.length("run").between(2, 4)).select(F.col("run").alias("word"))
    return words.counted_words(runs, short, unit=r"[\p{L}\p{N}]")


@query("tokenize_dictionary", r"""
    WITH listed AS (
        SELECT string_agg(w, '|' ORDER BY length(w) DESC, w) || '|[a-z0-9]+|[\p{L}\p{N}]' AS pattern
        FROM (SELECT DISTINCT lower(unnest([p_name, string_split(p_name, ' ')[1], string_split(p_name, ' ')[2]])) AS w FROM part)),
    cut AS (SELECT doc_id, regexp_extract_all(lower(text), pattern) AS ws FROM documents, listed)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS words, md5(array_to_string(ws, ' ')) AS digest FROM cut""")
def tokenize_dictionary(t: Tables):
    """Documents cut by the part names and their words; the list is a setting, here a few dozen names."""
    names = {r.p_name for r in t.table("part").select("p_name").distinct().collect()}
    listed = names | {word for name in names for word in name.split(" ")[:2]}
    cut = t.table("documents").select("doc_id", words_of("text", listed).alias("ws"))
    return cut.select("doc_id", F.size("ws").cast("long").alias("words"), F.md5(F.array_join("ws", " ").cast("binary")).alias("digest"))


_FACT_ROUTES = """
    ('order_info', 'insert', 'kafka', 'orders', 'id,user_id,order_status,total_amount,create_time', NULL, NULL),
    ('order_detail', 'insert', 'kafka', 'details', 'id,order_id,sku_id,split_total_amount,create_time', NULL, NULL)"""


def _as_connect_records(t: Tables, rows, name: str, columns: list[str]):
    """Rows as the connector sends inserts: operation code and an image in which every value is text."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c == "create_time" else F.col(c).cast("string")
    image = F.struct(*[text(c).alias(c) for c in columns], F.lit("x").alias("unrouted"))
    # What follows is work on every row, so rows are dealt to all cores first: a file gives few tasks.
    dealt = rows.select(*columns).repartition(3 * t.spark.sparkContext.defaultParallelism, *columns)
    return dealt.select(F.lit(f"source.shop.{name}").alias("topic"), F.to_json(F.struct(F.lit("c").alias("op"), image.alias("after"))).alias("value"))


@query("cdc_to_order_wide", f"""
    SELECT CAST(l_linenumber AS BIGINT) AS detail_id, o_orderkey AS order_id, l_partkey AS sku_id,
           CAST({_MONEY} AS DOUBLE) AS split_total_amount, {_STATUS_SQL} AS order_status, o_custkey AS user_id,
           o_totalprice AS total_amount, strftime(o_orderdate, '{_DATE}') AS create_time,
           strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND {_NEAR_SQL}""")
def cdc_to_order_wide(t: Tables):
    """From connector records through change lines, routing and fact messages to joined orders."""
    routes = t.spark.sql(f"SELECT * FROM VALUES {_FACT_ROUTES} AS t({ROUTE_NAMES})")
    sent = {}
    for name, topic, rows, columns in (
        ("order_info", "orders", t.orders(), ["id", "user_id", "order_status", "total_amount", "create_time"]),
        ("order_detail", "details", t.details(), ["id", "order_id", "sku_id", "split_total_amount", "create_time"]),
    ):
        lines = jobs.change_messages(_as_connect_records(t, rows, name, columns))
        routed = changes.route_by_config(changes.with_after_image(changes.parse_changes(lines)), routes)
        sent[topic] = routed_messages(changes.facts(routed)).where(F.col("topic") == topic)
    wide = orders.order_wide(records(sent["orders"], "dwd_order_info"), records(sent["details"], "dwd_order_detail"), **_BOUNDS)
    return wide.select(
        "detail_id", "order_id", "sku_id", "split_total_amount", "order_status", "user_id", "total_amount",
        "create_time", "create_date", "create_hour")
