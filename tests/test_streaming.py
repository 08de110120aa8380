"""Streaming forms against the batch forms, one small file per micro-batch."""

import json
import os
import random
import uuid
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from millrace.operators import alerts, joins, logs, orders, sql_stats, stats, visits
from millrace.session import checkpoint_root
from millrace.sinks import files
from millrace.sinks.kafka import messages
from millrace.sources.feeds import read_files, records
from millrace.streaming import jobs, keyed
from tests.conftest import rows
from tests.test_visits import jumps_by_hand

T = 1_608_533_530_000
END = T + 10_000_000


class Feeds:
    """Folders of text files fed in file order."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0

    def put(self, name, *batches):
        folder = f"{self.root}/{name}"
        os.makedirs(folder, exist_ok=True)
        for i, batch in enumerate(batches):
            path = f"{folder}/{i:04d}.txt"
            with open(path, "w") as out:
                out.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in batch)
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        return name

    def stream(self, name):
        return read_files(self.spark, f"{self.root}/{name}", files_per_trigger=1)

    def batch(self, name):
        return read_files(self.spark, f"{self.root}/{name}", streaming=False)

    def run(self, df, writer=None):
        """All rows an available-now run of ``df`` writes."""
        self.n += 1
        out = f"{self.root}/out{self.n}"
        checkpoint = f"{checkpoint_root(self.spark, self.root)}/{uuid.uuid4()}"
        query = jobs.start(df, writer or files.append(out), checkpoint=checkpoint, every=None)
        assert query.awaitTermination(180)
        if query.exception():
            raise query.exception()
        return None if writer else self.spark.read.parquet(out).drop("batch_id")


@pytest.fixture
def feeds(spark, tmp_path):
    return Feeds(spark, str(tmp_path))


def chunks(items, size):
    return [items[i:i + size] for i in range(0, len(items), size)]


def log(i, mid, ts, last=None, is_new="0", **page):
    page = {"page_id": "home", "during_time": 5, **page}
    if last is not None:
        page["last_page_id"] = last
    common = {"mid": mid, "vc": "v1", "ch": "web", "ar": "n", "is_new": is_new}
    return {"log_id": f"{i:06d}", "common": common, "page": page, "ts": ts}


def random_logs(seed, n=300, step=1_500):
    rng = random.Random(seed)
    return [
        log(i, "hot" if rng.random() < 0.34 else f"m{rng.randrange(6)}", T + i * step,
            rng.choice([None, "", "home", "cart"]), rng.choice("01"))
        for i in range(n)
    ]


def pages_of(lines):
    return logs.page_logs(logs.parse_logs(lines))


def test_unique_visits_over_many_batches(feeds):
    """Forty batches over three days: one visit per device and day, none twice."""
    feeds.put("pages", *chunks(random_logs(1, n=240, step=1_080_000), 6))
    got = feeds.run(keyed.unique_visits(pages_of(feeds.stream("pages"))))
    day = F.to_date(F.timestamp_millis("ts")).cast("string")
    want = visits.unique_visits(pages_of(feeds.batch("pages")))
    assert rows(got, "mid", day) == rows(want, "mid", day)
    assert got.count() > 15


def test_daily_actives_stream(feeds):
    data = [{"mid": f"m{i % 7}", "uid": "u", "ts": T + i * 2_000_000} for i in range(120)]
    feeds.put("startup", *chunks(data, 10))
    got = feeds.run(jobs.dau(feeds.stream("startup")))
    want = visits.daily_actives(records(feeds.batch("startup"), "startup_log").withColumn("log_id", F.lit(0)))
    assert rows(got, "mid", "logDate") == rows(want, "mid", "logDate")


@pytest.mark.parametrize("seed", [1, 2])
def test_jumps_stream(feeds, seed):
    """Batch result, except pages the watermark cannot pass at the end of a bounded run."""
    data = random_logs(seed)
    closing = [log(999_990 + i, "end", END + i, "home") for i in range(1)]
    feeds.put("pages", *chunks(data, 25), closing, [log(999_999, "end", END + 60_000, "home")])
    got = feeds.run(keyed.user_jumps(pages_of(feeds.stream("pages")), shards=3))
    hand = jumps_by_hand(
        [(d["log_id"], d["common"]["mid"], d["page"].get("last_page_id"), d["ts"]) for d in data], 10_000
    )
    assert sorted(r.log_id for r in got.collect()) == hand
    want = visits.user_jumps(pages_of(feeds.batch("pages")))
    assert rows(got) == rows(want)


def test_jumps_with_disorder_inside_the_delay(feeds):
    data = random_logs(7, n=120)
    rng = random.Random(3)
    shuffled = sorted(data, key=lambda d: d["ts"] + rng.randrange(0, 8_000))
    feeds.put("pages", *chunks(shuffled, 6), [log(999_998, "end", END, "x")], [log(999_999, "end", END + 60_000, "x")])
    got = feeds.run(keyed.user_jumps(pages_of(feeds.stream("pages"))))
    assert rows(got, "log_id") == rows(visits.user_jumps(pages_of(feeds.batch("pages"))), "log_id")


def test_repair_stream(feeds, spark):
    data = random_logs(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        feeds.put("logs", *chunks(data, 30))
        got = feeds.run(jobs.base_log(feeds.stream("logs")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = visits.repair_is_new(logs.parse_logs(feeds.batch("logs")))
    assert rows(got, "log_id", "mid", "is_new", "ts", "page") == rows(want, "log_id", "mid", "is_new", "ts", "page")


def test_base_log_splits_one_stream(feeds, spark, tmp_path):
    shown = log(1, "a", T, None, "1", page_id="list")
    shown["displays"] = [{"item": "1", "item_type": "sku_id"}, {"item": "2", "item_type": "sku_id"}]
    begin = {"common": {"mid": "a", "is_new": "1"}, "start": {"entry": "icon"}, "ts": T + 1}
    feeds.put("raw", [shown, "broken {"], [begin])
    names = ["dwd_start_log", "dwd_page_log", "dwd_display_log"]
    writers = {n: files.append(str(tmp_path / n)) for n in names}
    feeds.run(jobs.base_log(feeds.stream("raw")), jobs.split_log_writer(writers))
    start, page, display = (spark.read.parquet(str(tmp_path / n)) for n in names)
    assert rows(start, "mid", "is_new") == [("a", "0")]
    assert rows(page, "mid", "is_new") == [("a", "1")]
    assert rows(display, "page_id", "item") == [("list", "1"), ("list", "2")]
    dirty = feeds.run(jobs.dirty_log(feeds.stream("raw")))
    assert rows(dirty) == [("broken {",)]


def test_visit_chain_to_visitor_stats(feeds, spark):
    """Page log -> unique visits and jumps as topics of their own -> visitor statistics."""
    data = random_logs(5, n=200)
    feeds.put("pages", *chunks(data, 20), [log(999_998, "end", END, "x")], [log(999_999, "end", END + 10**8, "x")])
    feeds.put("visit", *[[r.value for r in feeds.run(jobs.unique_visit(feeds.stream("pages"))).collect()]])
    feeds.put("jump", *[[r.value for r in feeds.run(jobs.user_jump(feeds.stream("pages"))).collect()]])
    late = [log(999_999, "end", END + 10**8, "x")]
    feeds.put("visit2", [r.value for r in feeds.batch("visit").collect()], late)
    feeds.put("jump2", [r.value for r in feeds.batch("jump").collect()], late)
    got = feeds.run(jobs.visitor_stats(feeds.stream("pages"), feeds.stream("visit2"), feeds.stream("jump2")))
    pages = pages_of(feeds.batch("pages"))
    want = stats.visitor_stats(pages, visits.unique_visits(pages), visits.user_jumps(pages))
    cut = F.col("ts") < END
    keep = ["stt", "edt", "is_new", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]
    assert rows(got.where(cut), *keep) == rows(want.where(cut), *keep)
    # Which entry page of one micro-batch comes first is not fixed, the number of visits is.
    visits_of = lambda df: df.where(cut).agg(F.sum("uv_ct")).first()[0]
    assert visits_of(got) == visits_of(want) > 0
    assert got.agg(F.sum("uj_ct")).first()[0] > 0


def test_keyword_stats_stream(feeds):
    data = [
        log(i, "a", T + i * 900, "search", item=f"red tea {i % 3}", item_type="keyword") for i in range(60)
    ]
    end = [log(99, "a", END, "search", item="end", item_type="keyword")]
    feeds.put("pages", *chunks(data, 10), end)
    got = feeds.run(jobs.keyword_stats(feeds.stream("pages")))
    want = stats.keyword_stats(pages_of(feeds.batch("pages"))).where("keyword <> 'end'")
    assert rows(got, "keyword", "ct", "stt", "edt", "ts") == rows(want, "keyword", "ct", "stt", "edt", "ts")


def test_sql_statistics_over_streaming_views(feeds, spark):
    data = [log(i, "a", T + i * 900, "search", item=f"red tea {i % 3}", item_type="keyword") for i in range(60)]
    feeds.put("pages", *chunks(data, 10), [log(99, "a", END, "search", item="end", item_type="keyword")])
    timed = pages_of(feeds.stream("pages")).withColumn("event_time", F.timestamp_millis("ts"))
    timed.withWatermark("event_time", "2 seconds").createOrReplaceTempView("page_log")
    got = feeds.run(sql_stats.keyword_stats(spark, "page_log"))
    want = stats.keyword_stats(pages_of(feeds.batch("pages"))).where("keyword <> 'end'")
    assert rows(got, "keyword", "ct", "stt", "edt", "ts") == rows(want, "keyword", "ct", "stt", "edt", "ts")
    wide = [{"order_id": i // 3, "province_id": i % 2, "split_total_amount": 1.5, "event_time": clock(i * 2)} for i in range(60)]
    feeds.put("wide", *chunks(wide, 20), [{"order_id": -1, "event_time": clock(7_200)}])
    schema = _parse_datatype_string(
        "order_id long, province_id long, province_name string, province_area_code string, province_iso_code string, "
        "province_3166_2_code string, split_total_amount decimal(16,2), event_time timestamp")
    logs.parse_clean(feeds.stream("wide"), schema).withWatermark("event_time", "1 second").createOrReplaceTempView("wide_log")
    got = feeds.run(sql_stats.province_stats(spark, "wide_log"))
    want = stats.province_stats(logs.parse_clean(feeds.batch("wide"), schema)).where("order_amount is not null")
    assert rows(got) == rows(want) and got.count() == 24


def clock(seconds):
    return f"2021-03-01 {10 + seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"


def shop(feeds, n=60):
    order = [
        {"id": i, "province_id": i % 3, "user_id": i % 5, "total_amount": 10 + i, "create_time": clock(i * 4)}
        for i in range(n)
    ]
    detail = [
        {"id": 10 * i + j, "order_id": i, "sku_id": (i + j) % 7, "sku_num": 2, "split_total_amount": 1.25,
         "order_price": 1.25, "create_time": clock(max(i * 4 + (-4, 3, 9)[j], 0))}
        for i in range(n) for j in range(3)
    ]
    payment = [
        {"id": i, "order_id": i, "user_id": i % 5, "total_amount": 9, "create_time": clock(i * 4 + 60)} for i in range(n)
    ]
    end = clock(7_200)
    feeds.put("order", *chunks(order, 15), [{"id": -1, "create_time": end}])
    feeds.put("detail", *chunks(detail, 45), [{"id": -1, "order_id": -1, "create_time": end}])
    feeds.put("payment", *chunks(payment, 15), [{"id": -1, "order_id": -9, "create_time": end}])


def wide_of(read, delay=None):
    return orders.order_wide(
        records(read("order"), "dwd_order_info"), records(read("detail"), "dwd_order_detail"), delay=delay
    )


def test_order_and_payment_wide_stream(feeds):
    shop(feeds)
    wide = wide_of(feeds.batch)
    got = feeds.run(wide_of(feeds.stream, "10 seconds"))
    pairs = ["order_id", "detail_id", "split_total_amount", "create_hour"]
    assert rows(got, *pairs) == rows(wide, *pairs) and got.count() > 60
    feeds.put("wide", *chunks([r.value for r in wide.select(F.to_json(F.struct("*")).alias("value")).orderBy(
        "create_time").collect()], 40))

    def paid_of(read, delay=None):
        from pyspark.sql.types import StructType

        schema = StructType([f for f in wide.schema if f.name != "event_time"])
        rows_ = logs.parse_clean(read("wide"), schema)
        return orders.payment_wide(records(read("payment"), "dwd_payment_info"), rows_, delay=delay)

    got = feeds.run(paid_of(feeds.stream, "10 seconds"))
    assert rows(got, "payment_id", "detail_id") == rows(paid_of(feeds.batch), "payment_id", "detail_id")
    assert got.count() > 60


def test_wide_facts_through_their_topics(feeds, spark):
    """Orders and details -> wide order topic -> wide payment topic, each job reading lines."""
    shop(feeds, 20)
    one = lambda text: spark.sql(text)
    dims = {
        "user": one("SELECT CAST(id AS STRING) ID, 'F' GENDER, '2000-01-01' BIRTHDAY FROM range(5)"),
        "province": one("SELECT CAST(id AS STRING) ID, 'n' NAME, 'a' AREA_CODE, 'i' ISO_CODE, '3' ISO_3166_2 FROM range(3)"),
        "sku": one("SELECT CAST(id AS STRING) ID, 's' SPU_ID, 't' TM_ID, 'c' CATEGORY3_ID FROM range(7)"),
        "spu": one("SELECT 's' ID, 'spu' SPU_NAME"), "trademark": one("SELECT 't' ID, 'tm' TM_NAME"),
        "category3": one("SELECT 'c' ID, 'cat' NAME"),
    }
    wide = feeds.run(messages(jobs.order_wide(feeds.stream("order"), feeds.stream("detail"), dims, "2021-03-01", delay="10 seconds")))
    feeds.put("wide", *chunks([r.value for r in wide.collect()], 20))
    back = records(feeds.batch("wide"), "dwm_order_wide")
    assert rows(back, "order_id", "detail_id") == rows(wide_of(feeds.batch).where("order_id >= 0"), "order_id", "detail_id")
    assert back.where("tm_name = 'tm' AND user_age = 21 AND split_total_amount = 1.25").count() == back.count() > 20
    stream = records(feeds.stream("wide"), "dwm_order_wide")
    paid = feeds.run(messages(jobs.payment_wide(feeds.stream("payment"), stream, delay="1 hour")))
    feeds.put("paid", [r.value for r in paid.collect()])
    got = records(feeds.batch("paid"), "dwm_payment_wide")
    want = jobs.payment_wide(feeds.batch("payment"), back)
    assert rows(got) == rows(want) and got.count() == back.count()


def test_dimensions_are_read_anew_per_micro_batch(feeds, spark, tmp_path):
    """A product renamed between two micro-batches shows its new name in the second."""
    feeds.put("touch", [{"sku_id": 1, "create_time": clock(0)}], [{"sku_id": 1, "create_time": clock(1)}])
    reads = []

    def dims():
        reads.append(1)
        return {"sku": spark.sql(f"SELECT '1' ID, 'name {len(reads)}' SKU_NAME")}

    spec = joins.DimSpec("sku", "sku_id", {"sku_name": "SKU_NAME"})
    out = str(tmp_path / "named")
    write = jobs.enrich_writer(dims, lambda: [spec], files.append(out), ["create_time", "sku_name"])
    feeds.run(records(feeds.stream("touch"), "dwd_favor_info"), write)
    assert rows(spark.read.parquet(out), "create_time", "sku_name") == [(clock(0), "name 1"), (clock(1), "name 2")]


def test_interval_join_feeds_province_stats_in_one_query(feeds, spark):
    shop(feeds)
    provinces = spark.sql(
        "SELECT id ID, concat('P', id) NAME, 'a' AREA_CODE, 'b' ISO_CODE, 'c' ISO_3166_2 FROM VALUES (0L),(1L),(2L) AS t(id)"
    )

    def with_names(wide):
        return joins.enrich(wide, {"province": provinces}, joins.order_dims("2021-03-01")[1:2])

    got = feeds.run(jobs.province_stats(with_names(wide_of(feeds.stream, "10 seconds"))))
    want = stats.province_stats(with_names(wide_of(feeds.batch)))
    keep = ["stt", "province_name", "order_amount", "order_count"]
    closed = F.col("stt") < "2021-03-01 10:03:00"
    assert rows(got.where(closed), *keep) == rows(want.where(closed), *keep) and got.count() > 20


def test_product_stats_stream(feeds, spark):
    shop(feeds, 30)
    end = clock(7_200)
    touch = [{"sku_id": i % 7, "order_id": i % 9, "refund_amount": 0.5, "appraise": "1201" if i % 2 else "1203",
              "create_time": clock(i * 2)} for i in range(60)]
    for name in ("favor", "cart", "refund", "comment"):
        feeds.put(name, *chunks(touch, 20), [{"sku_id": 99, "create_time": end}])
    clicks = [log(i, "a", 1_614_592_800_000 + i * 2_000, "x", page_id="good_detail", item=str(i % 7), item_type="sku_id")
              for i in range(60)]
    for c in clicks:
        c["displays"] = [{"item": "3", "item_type": "sku_id"}]
    feeds.put("pages", *chunks(clicks, 20), [log(99, "a", 1_614_600_000_000, "x", page_id="good_detail", item="99", item_type="sku_id")])
    dims = {
        "sku": spark.sql("SELECT CAST(id AS STRING) ID, concat('sku', id) SKU_NAME, '1.50' PRICE, 's' SPU_ID, 't' TM_ID, 'c' CATEGORY3_ID FROM range(7)"),
        "spu": spark.sql("SELECT 's' ID, 'spu' SPU_NAME"),
        "trademark": spark.sql("SELECT 't' ID, 'tm' TM_NAME"),
        "category3": spark.sql("SELECT 'c' ID, 'cat' NAME"),
    }
    # Wide rows come from their own topics.
    wide = wide_of(feeds.batch)
    as_lines = lambda df: [r.value for r in df.select(F.to_json(F.struct("*")).alias("value")).collect()]
    feeds.put("wide", as_lines(wide), [{"order_id": 1, "sku_id": 99, "create_time": end}])
    paid = orders.payment_wide(records(feeds.batch("payment"), "dwd_payment_info"), wide)
    feeds.put("paid", as_lines(paid), [{"order_id": 1, "sku_id": 99, "payment_create_time": end}])

    def run(read):
        return jobs.product_stats(
            read("pages"), read("favor"), read("cart"), logs.parse_clean(read("wide"), wide.schema),
            logs.parse_clean(read("paid"), paid.schema), read("refund"), read("comment"), dims, delay="10 seconds",
        )

    got, want = feeds.run(run(feeds.stream)), run(feeds.batch)
    assert rows(got.drop("ts")) == rows(want.drop("ts"))
    assert got.agg(F.sum("order_ct"), F.sum("paid_order_ct"), F.sum("click_ct")).first()[2] == 60


def test_coupon_alert_stream(feeds):
    data = [
        {"mid": f"m{i % 4}", "uid": f"u{i % 5}", "evid": "clickItem" if i % 41 == 0 else "coupon", "itemid": "i",
         "ts": T + i * 5_000} for i in range(160)
    ]
    feeds.put("events", *chunks(data, 20), [{"mid": "end", "evid": "x", "ts": END}])
    got = feeds.run(jobs.coupon_alert(feeds.stream("events")))
    want = alerts.coupon_alerts(records(feeds.batch("events"), "event_log"))
    assert rows(got) == rows(want) and got.count() > 3


def test_throttled_alerts_stream(feeds, spark, tmp_path):
    """The last alert of a device and minute wins, on streams as in the batch form."""
    schema = "mid string, stt string, uid_ct long, ts long"
    data = [{"mid": f"m{i % 2}", "stt": f"s{i}", "uid_ct": i, "ts": T + i * 7_000} for i in range(40)]
    feeds.put("alerts", *chunks(data, 4))
    parsed = lambda read: logs.parse_clean(read("alerts"), _parse_datatype_string(schema))
    table = files.UpsertTable(str(tmp_path / "docs"), ["doc_id"], ["ts", "stt"])
    feeds.run(parsed(feeds.stream), jobs.alert_writer(table))
    want = alerts.throttled(parsed(feeds.batch))
    columns = ("doc_id", "mid", "stt", "uid_ct", "ts")
    assert rows(table.read(spark), *columns) == rows(want, *columns)


def test_alert_documents_from_streams(feeds, spark, tmp_path):
    """Alerts with their users, items and events, written by id from the alerts and events of a stream."""
    data = [
        {"mid": f"m{i % 4}", "uid": f"u{i % 5}", "evid": "clickItem" if i % 41 == 0 else "coupon", "itemid": f"i{i % 3}",
         "ts": T + i * 5_000} for i in range(160)
    ]
    feeds.put("events", *chunks(data, 20), [{"mid": "end", "evid": "x", "ts": END}])
    read = lambda: records(feeds.batch("events"), "event_log")
    table = files.UpsertTable(str(tmp_path / "docs"), ["doc_id"], ["ts", "stt"])
    feeds.run(jobs.coupon_alert(feeds.stream("events")), jobs.alert_writer(table, read))
    found = alerts.coupon_alerts(read())
    want = alerts.throttled(alerts.alert_documents(found, alerts.alert_evidence(found, read())))
    columns = ("doc_id", "stt", "uids", "itemIds", "events")
    assert rows(table.read(spark), *columns) == rows(want, *columns) and want.count() > 3


@pytest.mark.parametrize("operator", ["unique", "daily", "jumps", "repair"])
def test_missing_devices_and_times_agree_with_batch(feeds, operator):
    """A record without a device or a time never stops a stream, and both forms say the same about it."""
    data = [log(i, f"m{i % 3}", T + i * 20_000) for i in range(12)]
    for i, record in enumerate(data):
        if i % 4 == 1:
            record.pop("ts")
        if i % 4 == 2:
            record["common"].pop("mid")
        record["common"]["is_new"] = "1" if i % 2 else "0"
    feeds.put("pages", *chunks(data, 3), [log(99, "end", END, "home")])
    parsed = lambda read: logs.page_logs(logs.parse_logs(read("pages")))
    stream, batch = {
        "unique": (keyed.unique_visits, visits.unique_visits), "daily": (keyed.daily_actives, visits.daily_actives),
        "jumps": (keyed.user_jumps, visits.user_jumps), "repair": (keyed.repair_is_new, visits.repair_is_new)}[operator]
    got, want = feeds.run(stream(parsed(feeds.stream))), batch(parsed(feeds.batch))
    if operator == "jumps":
        seen = [r for r in rows(want, "log_id", "mid", "ts") if r[1] != "end"]
        assert rows(got, "log_id", "mid", "ts") == seen and all(m is not None and t is not None for _, m, t in seen) and seen
    elif operator == "repair":
        assert rows(got, "log_id", "mid") == rows(want, "log_id", "mid") and got.count() == 13
        # of a device's claims one is kept, and a record without a device is left as it is
        kept = lambda df: rows(df.where("is_new = '1'").groupBy("mid").count())
        assert kept(got) == kept(want)
    else:
        timed = lambda df: df.where("ts IS NOT NULL AND mid IS NOT NULL")
        assert timed(got).select("mid").distinct().count() == timed(want).select("mid").distinct().count() > 0


def test_sale_detail_stream_with_users(feeds, spark, tmp_path):
    order = [{"id": f"o{i}", "order_status": "1001", "user_id": f"u{i % 3}", "create_time": clock(i)} for i in range(20)]
    detail = [{"id": f"d{i}", "order_id": f"o{i // 2}", "sku_id": "s", "sku_name": "tea", "order_price": "1.5"} for i in range(50)]
    feeds.put("order", *chunks(order, 5))
    feeds.put("detail", *chunks(list(reversed(detail)), 20))
    users = lambda: spark.sql("SELECT 'u1' id, '2000-03-01' birthday, 'F' gender, '2' user_level")
    out = str(tmp_path / "sales")
    feeds.run(
        jobs.sale_detail(feeds.stream("order"), feeds.stream("detail")),
        jobs.sale_user_writer(users, lambda: "2021-03-01", files.append(out)),
    )
    got = spark.read.parquet(out)
    want = joins.with_sale_user(
        joins.sale_details(orders.with_create_parts(records(feeds.batch("order"), "shop_order")),
                           records(feeds.batch("detail"), "shop_order_detail")), users(), "2021-03-01")
    keep = ["order_detail_id", "order_id", "user_id", "user_gender", "user_age", "sku_price", "dt"]
    assert rows(got, *keep) == rows(want, *keep) and got.count() == 40


def test_full_outer_stream(feeds):
    from millrace.streaming.joins import full_outer_join

    end = clock(7_200)
    feeds.put("l", [{"id": 1, "create_time": clock(0)}, {"id": 2, "create_time": clock(1)}],
              [{"id": 98, "create_time": end}], [{"id": 97, "create_time": clock(9_000)}])
    feeds.put("r", [{"id": 5, "order_id": 1, "create_time": clock(2)}, {"id": 6, "order_id": 3, "create_time": clock(2)}],
              [{"id": 7, "order_id": 99, "create_time": end}], [{"id": 8, "order_id": 96, "create_time": clock(9_000)}])
    left = orders.with_event_time(records(feeds.stream("l"), "dwd_order_info"), name="lt").select("id", "lt")
    right = orders.with_event_time(records(feeds.stream("r"), "dwd_order_detail"), name="rt").select(
        F.col("id").alias("rid"), "order_id", "rt")
    got = feeds.run(full_outer_join(
        left, right, left_key="id", right_key="order_id", left_time="lt", right_time="rt",
        wait=timedelta(seconds=30), delay="1 second",
    ))
    early = got.where(F.coalesce("id", F.lit(0)) < 90).where(F.coalesce("order_id", F.lit(0)) < 90)
    assert rows(early, "id", "rid") == [(1, 5), (2, None), (None, 6)]


def test_base_db_reads_the_routes_anew(feeds, spark, tmp_path):
    change = lambda table, op, **data: {"database": "shop", "tableName": table, "type": op, "data": data}
    feeds.put(
        "db",
        [change("order_info", "insert", id="1", secret="s"), change("base_trademark", "insert", id="1", tm_name="acme", logo="x")],
        [change("order_info", "insert", id="2"), change("base_trademark", "update", id="1", tm_name="ACME"), "junk"],
    )
    reads = []

    def routes():
        reads.append(1)
        columns = "id" if len(reads) == 1 else "id,tm_name"
        return spark.sql(f"""SELECT * FROM VALUES
            ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id', NULL, NULL),
            ('base_trademark', 'insert', 'hbase', 'dim_tm', 'id,tm_name', NULL, NULL),
            ('base_trademark', 'update', 'hbase', 'dim_tm', '{columns}', NULL, NULL),
            ('base_code', 'insert', 'hbase', 'dim_empty', 'code,name', 'code', NULL)
            AS t(sourceTable, operateType, sinkType, sinkTable, sinkColumns, sinkPk, sinkExtend)""")

    def table(name, key, columns):
        return files.UpsertTable(str(tmp_path / name), [key], ["batch", "seq"], image="image", columns=columns)

    facts = str(tmp_path / "facts")
    feeds.run(feeds.stream("db"), jobs.base_db_writer(routes, files.by_topic(facts), table))
    assert rows(spark.read.json(facts), "topic", "value") == [("dwd_order_info", '{"id":"1"}'), ("dwd_order_info", '{"id":"2"}')]
    assert rows(table("dim_tm", "id", ["id", "tm_name"]).read(spark), "id", "tm_name") == [("1", "ACME")] and len(reads) == 2
    # configured, and without any row so far
    assert table("dim_empty", "code", ["code", "name"]).read(spark).columns[:2] == ["code", "name"]
    assert table("dim_empty", "code", ["code"]).read(spark).count() == 0


def test_one_dimension_has_one_key(spark, tmp_path):
    routes = spark.sql("""SELECT * FROM VALUES ('a', 'insert', 'hbase', 'dim', 'id,x', NULL, NULL), ('a', 'update', 'hbase', 'dim', 'id,x', 'x', NULL)
        AS t(sourceTable, operateType, sinkType, sinkTable, sinkColumns, sinkPk, sinkExtend)""")
    write = jobs.base_db_writer(lambda: routes, lambda *_: None, lambda *_: None)
    with pytest.raises(ValueError, match="different keys"):
        write(spark.createDataFrame([("{}",)], "value string"), 0)


def test_connector_records_reach_the_province_statistics(feeds, spark):
    """Connector to routing to facts to statistics, with numbers sent as text, as the topics carry them."""
    def envelope(table, **image):
        return json.dumps({"topic": f"s.shop.{table}", "value": json.dumps({"op": "c", "after": image})})

    feeds.put("connect", [
        envelope("order_info", id="1", province_id="7", user_id=5, total_amount="12.50", create_time="2021-03-01 09:00:00"),
        envelope("order_detail", id="11", order_id="1", sku_id=3, split_total_amount="12.50", create_time="2021-03-01 09:00:01"),
        envelope("order_info", id="2", province_id="7", user_id="6", total_amount="x", create_time="2021-03-01 09:30:00"),
        envelope("order_detail", id="12", order_id=2, sku_id="3", split_total_amount=2, create_time="2021-03-01 09:30:01")])
    connector = feeds.stream("connect").select(F.json_tuple("value", "topic", "value").alias("topic", "value"))
    feeds.put("db", [r.value for r in feeds.run(jobs.change_messages(connector)).collect()])
    routes = spark.sql("""SELECT * FROM VALUES
        ('order_info', 'insert', 'kafka', 'orders', 'id,province_id,user_id,total_amount,create_time', NULL, NULL),
        ('order_detail', 'insert', 'kafka', 'details', 'id,order_id,sku_id,split_total_amount,create_time', NULL, NULL)
        AS t(sourceTable, operateType, sinkType, sinkTable, sinkColumns, sinkPk, sinkExtend)""")
    sent = []
    feeds.run(feeds.stream("db"), jobs.base_db_writer(lambda: routes, lambda batch, _: sent.extend(batch.collect()), lambda *_: None))
    for topic in ("orders", "details"):
        feeds.put(topic, [r.value for r in sent if r.topic == topic])
    wide = jobs.order_wide(feeds.batch("orders"), feeds.batch("details"))
    assert rows(wide, "order_id", "sku_id", "user_id") == [(1, 3, 5), (2, 3, 6)]


def test_user_stream_keeps_the_latest(feeds, spark, tmp_path):
    feeds.put("user", [{"id": "1", "user_level": "1"}, {"id": "2", "user_level": "1"}], [{"id": "1", "user_level": "3"}])
    table = files.UpsertTable(str(tmp_path / "users"), ["id"], ["batch"])
    feeds.run(jobs.user_info(feeds.stream("user")), lambda b, i: table.write(b.withColumn("batch", F.lit(i)), i))
    assert rows(table.read(spark), "id", "user_level") == [("1", "3"), ("2", "1")]


def test_gmv_stream(feeds):
    feeds.put("order", [{"id": "1", "total_amount": 2.5, "create_time": "2021-03-01 09:08:07"}])
    assert rows(feeds.run(jobs.gmv(feeds.stream("order"))), "create_date", "create_hour") == [("2021-03-01", "09")]


def test_connector_and_forwarder_stages(feeds):
    envelope = json.dumps({"op": "CREATE", "after": {"id": 1}})
    feeds.put("connect", [json.dumps({"topic": "s.shop.order_info", "value": envelope})])
    parsed = feeds.stream("connect").select(F.json_tuple("value", "topic", "value").alias("topic", "value"))
    feeds.put("db", [r.value for r in feeds.run(jobs.change_messages(parsed)).collect()])
    assert rows(feeds.run(jobs.forwarded(feeds.stream("db")))) == [("order_info", '{"id":"1"}')]


def test_rows_behind_the_watermark_are_dropped(feeds):
    search = lambda i, ts, word: log(i, "a", ts, "search", item=word, item_type="keyword")
    feeds.put("pages", [search(1, T, "one")], [search(2, T + 100_000, "two")],
              [search(3, T + 200_000, "three")], [search(4, T, "late")],
              [search(5, END, "end")])
    got = feeds.run(jobs.keyword_stats(feeds.stream("pages")))
    assert rows(got, "keyword") == [("one",), ("three",), ("two",)]
