from decimal import Decimal

from pyspark.sql import functions as F

from millrace.operators import alerts, stats
from tests.conftest import rows

T = 1_608_533_530_000  # 2020-12-21 06:52:10


def visitor_pages(spark, data):
    """(mid, last page, time spent, ts)"""
    return spark.createDataFrame(data, "mid string, last string, dur long, ts long").select(
        "mid", F.lit("v1").alias("vc"), F.lit("web").alias("ch"), F.lit("n").alias("ar"), F.lit("1").alias("is_new"),
        F.struct(F.col("last").alias("last_page_id"), F.col("dur").alias("during_time")).alias("page"), "ts",
    )


def test_visitor_stats(spark):
    pages = visitor_pages(spark, [("a", None, 5, T), ("a", "", 6, T + 9_999), ("b", "x", None, T + 10_000)])
    visits = pages.where(F.col("mid") == "a").limit(1)
    got = stats.visitor_stats(pages, visits, visits)
    assert rows(got, "stt", "edt", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum") == [
        ("2020-12-21 06:52:10", "2020-12-21 06:52:20", 1, 2, 1, 1, 11),
        ("2020-12-21 06:52:20", "2020-12-21 06:52:30", 0, 1, 0, 0, 0),
    ]


def test_product_stats_counts_orders_once(spark):
    at = "2021-03-01 10:00:01"
    wide = spark.createDataFrame(
        [(7, 1, 2, "5.50", "20.00", at), (7, 1, 1, "4.50", "20.00", at), (7, 2, 1, "1.00", "1.00", at)],
        "sku_id long, order_id long, sku_num long, split string, total string, create_time string",
    ).select("*", F.col("split").cast("decimal(16,2)").alias("split_total_amount"),
             F.col("total").cast("decimal(16,2)").alias("total_amount"))
    paid = wide.withColumnRenamed("create_time", "payment_create_time").where("order_id = 1")
    refunds = spark.createDataFrame([(7, 1, at), (7, 1, at)], "sku_id long, order_id long, create_time string").withColumn(
        "refund_amount", F.lit("0.25").cast("decimal(16,2)"))
    comments = spark.createDataFrame([(7, "1201", at), (7, "1204", at), (7, None, at)], "sku_id long, appraise string, create_time string")
    favors = spark.createDataFrame([(7, at), (8, "2021-03-01 10:00:10")], "sku_id long, create_time string")
    got = stats.product_stats([
        stats.order_rows(wide), stats.payment_rows(paid), stats.refund_rows(refunds), stats.comment_rows(comments),
        stats.favor_rows(favors), stats.cart_rows(favors),
    ])
    seven = got.where("sku_id = 7").first()
    assert (seven.order_ct, seven.paid_order_ct, seven.refund_order_ct) == (2, 1, 1)
    assert (seven.order_amount, seven.payment_amount, seven.refund_amount) == (Decimal("11.00"), Decimal("10.00"), Decimal("0.50"))
    assert (seven.order_sku_num, seven.comment_ct, seven.good_comment_ct, seven.favor_ct, seven.cart_ct) == (4, 3, 1, 1, 1)
    assert (seven.stt, seven.edt) == ("2021-03-01 10:00:00", "2021-03-01 10:00:10")
    eight = got.where("sku_id = 8").first()
    assert (eight.order_ct, eight.order_amount, eight.favor_ct) == (0, Decimal("0.00"), 1)
    whole = stats.product_stats([stats.order_rows(wide, amount="total_amount")]).first()
    assert whole.order_amount == Decimal("41.00")


def test_clicks_and_displays(spark):
    pages = spark.createDataFrame(
        [(("good_detail", "sku_id", "3"), [("7", "sku_id"), ("8", "activity_id")], T),
         (("good_detail", "activity_id", "4"), None, T), (("home", "sku_id", "5"), [], T)],
        "page struct<page_id string, item_type string, item string>, displays array<struct<item string, item_type string>>, ts long",
    )
    assert rows(stats.page_rows(pages), "sku_id", "kind") == [(3, "click"), (7, "display")]


def test_province_stats(spark):
    wide = spark.createDataFrame(
        [(1, "A", 10, "1.25"), (1, "A", 10, "2.25"), (1, "A", 11, "1.00"), (2, "B", 12, None)],
        "province_id long, province_name string, order_id long, amount string",
    ).select(
        "*", F.col("amount").cast("decimal(16,2)").alias("split_total_amount"),
        *[F.lit("x").alias(c) for c in ("province_area_code", "province_iso_code", "province_3166_2_code")],
        F.lit("2021-03-01 10:00:01").alias("create_time"),
    )
    want = [(1, Decimal("4.50"), 2), (2, None, 1)]
    assert rows(stats.province_stats(wide), "province_id", "order_amount", "order_count") == want
    by_id = stats.province_stats(wide, keys=["province_id"])
    assert rows(by_id, "province_id", "order_amount", "order_count") == want


def test_keyword_stats(spark):
    pages = spark.createDataFrame(
        [(("search", "keyword", "Red TEA"), T + 999), (("search", "keyword", "tea"), T + 1), (("home", "keyword", "tea"), T)],
        "page struct<last_page_id string, item_type string, item string>, ts long",
    )
    got = stats.keyword_stats(pages)
    assert rows(got, "keyword", "ct", "source", "ts") == [("red", 1, "SEARCH", T + 999), ("tea", 2, "SEARCH", T + 999)]


EVENTS = "mid string, uid string, evid string, itemid string, ts long"


def taken(mid, uid, ts=T, evid="coupon", item="i1"):
    return (mid, uid, evid, item, ts)


def test_alert_needs_three_users_and_no_click(spark):
    data = (
        [taken("three", f"u{i}") for i in range(3)]
        + [taken("clicked", f"u{i}") for i in range(3)] + [taken("clicked", "u1", evid="clickItem")]
        + [taken("same", "u1") for _ in range(3)]
        + [taken("two", f"u{i}") for i in range(2)] + [taken("two", "u9", evid="addCart")]
    )
    df = spark.createDataFrame(data, EVENTS)
    got = alerts.coupon_alerts(df, "5 minutes", None)
    assert rows(got, "mid", "uid_ct", "event_ct", "ts") == [("three", 3, 3, T)]
    assert rows(alerts.coupon_alerts(df, "5 minutes", None, min_users=1), "mid") == [("same",), ("three",), ("two",)]


def test_sliding_alerts_equal_plain_sliding_windows(spark):
    data = [taken(f"m{i % 3}", f"u{i % 5}", T + i * 7_000, evid="clickItem" if i % 17 == 0 else "coupon") for i in range(120)]
    df = spark.createDataFrame(data, EVENTS)
    got = rows(alerts.coupon_alerts(df, "5 minutes", "1 minute"), "stt", "mid", "uid_ct", "event_ct", "ts")
    plain = (
        df.groupBy(F.window(F.timestamp_millis("ts"), "5 minutes", "1 minute"), "mid")
        .agg(F.countDistinct(F.when(F.col("evid") == "coupon", F.col("uid"))).alias("uid_ct"), F.count("*").alias("event_ct"),
             F.max("ts").alias("ts"), F.max((F.col("evid") == "clickItem").cast("int")).alias("c"))
        .where("uid_ct >= 3 AND c = 0")
        .select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("stt"), "mid", "uid_ct", "event_ct", "ts")
    )
    assert got == rows(plain) and got


def test_alert_documents_and_throttle(spark):
    data = [taken("m", f"u{i}", item=f"i{i % 2}") for i in range(3)] + [taken("m", "u1", T + 500, "addCart")]
    df = spark.createDataFrame(data, EVENTS)
    found = alerts.coupon_alerts(df)
    assert found.count() == 5
    evidence = alerts.alert_evidence(found, df)
    doc = alerts.alert_documents(found, evidence).orderBy("stt").first()
    assert (doc.uids, doc.itemIds) == (["u0", "u1", "u2"], ["i0", "i1"])
    assert [tuple(e) for e in doc.events] == [("addCart", 1), ("coupon", 3)]
    one, = alerts.throttled(found).collect()
    assert one.doc_id == f"m{(T + 500) // 60000}" and one.stt == "2020-12-21 06:52:00"


def test_the_rows_of_an_order_line_travel_as_one(spark):
    """Payment, refund and comment of a line are one row before the first shuffle, and the order of a comment is not counted."""
    df = spark.range(3).selectExpr("7 AS sku", "id AS o", "timestamp_seconds(100) AS t", "CAST(2 AS decimal(16,2)) AS a")
    made = stats.rows_in_one_pass(df, "sku", F.col("t"), "o", [
        ("payment", None, None, F.col("a")), ("refund", F.col("o") == 1, None, F.col("a")), ("comment", None, F.lit(1), None)])
    got = stats.product_stats([made])
    row = got.first()
    assert (row.paid_order_ct, row.refund_order_ct, row.order_ct, row.comment_ct, row.good_comment_ct) == (3, 1, 0, 3, 3)
    assert (row.payment_amount, row.refund_amount, row.order_amount) == (6, 2, 0)
    first = [x for x in got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n") if "hashpartitioning" in x][-1]
    assert "kind" not in first and "order_id" in first
