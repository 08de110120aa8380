import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions.moments import age_in_years
from millrace.operators import joins, orders
from millrace.schemas import ORDER_DETAIL, ORDER_INFO, ORDER_WIDE_COLUMNS, PAYMENT_INFO, PAYMENT_WIDE_COLUMNS
from tests.conftest import rows

T0 = datetime(2021, 3, 1, 10, 0, 0)


def order(id_, time, total="10.00", user=5):
    return {"id": id_, "user_id": user, "province_id": 1, "total_amount": Decimal(total), "create_time": time}


def detail(id_, order_id, time, sku=9):
    return {"id": id_, "order_id": order_id, "sku_id": sku, "create_time": time, "sku_num": 2}


def frame(spark, schema, dicts):
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema) for d in dicts], schema)


def test_bounds_are_inclusive(spark):
    o = frame(spark, ORDER_INFO, [order(1, "2021-03-01 10:00:00"), order(2, "2021-03-01 10:00:00")])
    d = frame(spark, ORDER_DETAIL, [
        detail(1, 1, "2021-03-01 10:00:05"), detail(2, 1, "2021-03-01 09:59:55"),
        detail(3, 1, "2021-03-01 10:00:06"), detail(4, 1, "2021-03-01 09:59:54"),
        detail(5, 3, "2021-03-01 10:00:00"), detail(6, 1, "no time"), detail(7, 1, "2021-03-01 10:00:01"),
    ])
    wide = orders.order_wide(o, d)
    assert rows(wide, "detail_id", "order_id") == [(1, 1), (2, 1), (7, 1)]
    assert wide.first().create_hour == "10" and wide.first().create_date == "2021-03-01"


def test_millisecond_outside_the_bounds(spark):
    left = spark.createDataFrame([(1, T0)], "lk int, lt timestamp")
    right = spark.createDataFrame(
        [(1, T0 + timedelta(seconds=5)), (1, T0 + timedelta(seconds=5, milliseconds=1)),
         (1, T0 - timedelta(seconds=5)), (1, T0 - timedelta(seconds=5, milliseconds=1))],
        "rk int, rt timestamp",
    )
    got = joins.interval_join(
        left, right, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
        lower=timedelta(seconds=-5), upper=timedelta(seconds=5),
    )
    assert got.columns == ["lk", "lt", "rk", "rt"]
    assert sorted(r.rt for r in got.collect()) == [T0 - timedelta(seconds=5), T0 + timedelta(seconds=5)]


@pytest.mark.parametrize("seed,lower,upper", [(1, -5, 5), (2, -900, 5), (3, 0, 0), (4, 3, 40), (5, -40, -3)])
def test_interval_join_against_all_pairs(spark, seed, lower, upper):
    """Random times around the epoch and a key holding a third of both sides."""
    rng = random.Random(seed)
    key = lambda: 0 if rng.random() < 0.34 else rng.randrange(1, 6)
    side = lambda: [(i, key(), rng.randrange(-3000, 3000)) for i in range(150)]
    left, right = side(), side()
    lo, hi = timedelta(seconds=lower), timedelta(seconds=upper)
    want = sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and lower <= b[2] - a[2] <= upper)
    to = lambda data, p: spark.createDataFrame(data, f"{p}i int, {p}k int, {p}s long").withColumn(
        f"{p}t", F.timestamp_seconds(f"{p}s"))
    got = joins.interval_join(
        to(left, "l"), to(right, "r"), left_key="lk", right_key="rk", left_time="lt", right_time="rt",
        lower=lo, upper=hi,
    )
    assert sorted((r.li, r.ri) for r in got.collect()) == want


def test_payment_wide_takes_the_payments_values(spark):
    o = frame(spark, ORDER_INFO, [order(1, "2021-03-01 10:00:00", "10.00", user=5)])
    d = frame(spark, ORDER_DETAIL, [detail(1, 1, "2021-03-01 10:00:00"), detail(2, 1, "2021-03-01 10:00:00", sku=9)])
    wide = orders.order_wide(o, d)
    pay = lambda i, time: {"id": i, "order_id": 1, "user_id": 6, "total_amount": Decimal("9.50"), "create_time": time}
    p = frame(spark, PAYMENT_INFO, [
        pay(1, "2021-03-01 10:15:00"), pay(2, "2021-03-01 10:15:01"), pay(3, "2021-03-01 09:59:55"),
        pay(4, "2021-03-01 09:59:54"),
    ])
    paid = orders.payment_wide(p, wide)
    assert rows(paid, "payment_id", "detail_id") == [(1, 1), (1, 2), (3, 1), (3, 2)]
    row = paid.first()
    assert (row.user_id, row.total_amount, row.order_create_time) == (6, Decimal("9.50"), "2021-03-01 10:00:00")


def dims(spark):
    one = lambda data, schema: spark.createDataFrame(data, schema)
    return {
        "user": one([("5", "M", "2000-01-01"), ("guest", "F", None)], "ID string, GENDER string, BIRTHDAY string"),
        "province": one([("1", "Anhui", "340000", "CN-34", "CN-AH")],
                        "ID string, NAME string, AREA_CODE string, ISO_CODE string, ISO_3166_2 string"),
        "sku": one([("9", "2.5", "tea", "90", "91", "92")],
                   "ID string, PRICE string, SKU_NAME string, SPU_ID string, TM_ID string, CATEGORY3_ID string"),
        "spu": one([("90", "Spu"), ("n/a", "odd")], "ID string, SPU_NAME string"),
        "trademark": one([("91", "Acme")], "ID string, TM_NAME string"),
        "category3": one([("92", "Drinks")], "ID string, NAME string"),
    }


def test_six_dimensions_and_missing_rows(spark):
    o = frame(spark, ORDER_INFO, [order(1, "2021-03-01 10:00:00"), order(2, "2021-03-01 10:00:00", user=77)])
    d = frame(spark, ORDER_DETAIL, [detail(1, 1, "2021-03-01 10:00:00"), detail(2, 2, "2021-03-01 10:00:00")])
    wide = orders.order_wide(o, d)
    inner = orders.order_wide_table(joins.enrich(wide, dims(spark), joins.order_dims("2021-03-01")))
    assert inner.columns == ORDER_WIDE_COLUMNS and len(ORDER_WIDE_COLUMNS) == 35
    row, = inner.collect()
    assert (row.user_age, row.user_gender, row.province_name, row.spu_name, row.tm_name, row.category3_name) == (
        21, "M", "Anhui", "Spu", "Acme", "Drinks",
    )
    for how in ("inner", "left"):
        specs = joins.order_dims("2021-03-01", how=how)
        columns = sorted(joins.enrich(wide, dims(spark), specs).columns)
        flat = joins.enrich(wide, dims(spark), specs, flatten=True)
        assert rows(flat, *columns) == rows(joins.enrich(wide, dims(spark), specs), *columns)
    left = joins.enrich(wide, dims(spark), joins.order_dims("2021-03-01", how="left"))
    assert rows(left, "order_id", "user_gender") == [(1, "M"), (2, None)]
    paid = orders.payment_wide_table(orders.payment_wide(
        frame(spark, PAYMENT_INFO, [{"id": 1, "order_id": 1, "create_time": "2021-03-01 10:00:00"}]), inner))
    assert paid.columns == PAYMENT_WIDE_COLUMNS and len(PAYMENT_WIDE_COLUMNS) == 36 and paid.count() == 1


def test_age_counts_365_day_spans(spark):
    df = spark.createDataFrame([("2020-03-02",), ("2020-03-01",), ("2020-02-29",), ("bad",)], "b string")
    assert [r[0] for r in df.select(age_in_years("b", "2021-03-01")).collect()] == [0, 1, 1, None]


def test_full_outer_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "lk int, lv string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "rk int, rv string")
    got = joins.full_outer_join(left, right, "lk", "rk").withColumn("branch", joins.join_branch("lv", "rv"))
    native = left.join(right, left.lk == right.rk, "full")
    assert rows(got.drop("branch")) == rows(native)
    assert rows(got, "lv", "rv", "branch") == [
        ("a", "x", "matched"), ("a", "y", "matched"), ("b", None, "left_only"), ("c", None, "left_only"),
        (None, "n", "right_only"), (None, "z", "right_only"),
    ]


def test_sale_detail_with_unknown_user(spark):
    o = spark.createDataFrame(
        [("1", "1001", "2021-03-01 10:11:12", "u1"), ("2", "1002", "2021-03-02 00:00:00", "u2")],
        "id string, order_status string, create_time string, user_id string",
    )
    d = spark.createDataFrame(
        [("d1", "1", "s1", "tea", "2.50"), ("d2", "2", "s2", "pot", "oops"), ("d3", "9", "s3", "cup", "1")],
        "id string, order_id string, sku_id string, sku_name string, order_price string",
    )
    users = spark.createDataFrame([("u1", "2000-03-01", "F", "3")], "id string, birthday string, gender string, user_level string")
    sales = joins.with_sale_user(joins.sale_details(orders.with_create_parts(o), d), users, "2021-03-01")
    assert rows(sales, "order_detail_id", "dt", "sku_price", "user_gender", "user_age", "user_level") == [
        ("d1", "2021-03-01", Decimal("2.50"), "F", 21, "3"), ("d2", "2021-03-02", None, None, 0, None),
    ]
