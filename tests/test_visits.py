import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import latest, reports, visits
from tests.conftest import rows

PAGES = "log_id long, mid string, last string, ts long"


def pages(spark, data):
    return spark.createDataFrame(data, PAGES).select(
        "log_id", "mid", F.struct(F.col("last").alias("last_page_id")).alias("page"), "ts"
    )


def jumps_by_hand(data, reach):
    out = []
    for mid in {d[1] for d in data}:
        line = sorted((d for d in data if d[1] == mid), key=lambda d: (d[3], d[0]))
        for here, after in zip(line, line[1:] + [None]):
            entry = not here[2]
            if entry and (after is None or after[3] - here[3] >= reach or not after[2]):
                out.append(here[0])
    return sorted(out)


def random_pages(seed, n=400, span=400_000):
    """A third of the pages belong to one device; times collide and straddle cells."""
    rng = random.Random(seed)
    return [
        (i, "hot" if rng.random() < 0.34 else f"m{rng.randrange(8)}", rng.choice([None, "", "home", "cart"]),
         rng.randrange(-span, span) // 500 * 500)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_jumps_against_hand_computation(spark, seed):
    data = random_pages(seed)
    got = visits.user_jumps(pages(spark, data), timedelta(seconds=10))
    assert sorted(r.log_id for r in got.collect()) == jumps_by_hand(data, 10_000)


def test_jump_at_exactly_the_limit(spark):
    data = [(1, "a", None, 0), (2, "a", "x", 10_000), (3, "b", None, 0), (4, "b", "x", 9_999), (5, "c", "", 5)]
    assert rows(visits.user_jumps(pages(spark, data)), "log_id") == [(1,), (5,)]


def test_repair_keeps_one_claim_per_device(spark):
    data = [
        (1, "a", "0", 5), (2, "a", "1", 7), (3, "a", "1", 7), (4, "a", "1", 6), (5, "a", "0", 9),
        (6, "b", "1", 1), (7, "b", "1", 1), (8, None, "1", 1), (9, None, "1", 2),
    ]
    df = spark.createDataFrame(data, "log_id long, mid string, is_new string, ts long")
    kept = visits.repair_is_new(df)
    assert kept.columns == df.columns
    got = {r.log_id: r.is_new for r in kept.collect()}
    assert got == {1: "0", 2: "0", 3: "0", 4: "1", 5: "0", 6: "1", 7: "0", 8: "1", 9: "1"}


def test_repair_of_identical_records_keeps_one(spark):
    df = spark.createDataFrame([(1, "a", "1", 5)] * 3, "log_id long, mid string, is_new string, ts long")
    assert [r.is_new for r in visits.repair_is_new(df).orderBy("is_new").collect()] == ["0", "0", "1"]


def test_unique_visit_per_day(spark):
    day = 86_400_000
    data = [
        (1, "a", "home", 10), (2, "a", "", 30), (3, "a", None, 20), (4, "a", None, day - 1), (5, "a", None, day),
        (6, "b", "home", 5),
    ]
    assert rows(visits.unique_visits(pages(spark, data)), "log_id") == [(3,), (5,)]


def test_dau_two_batches_of_a_day(spark):
    schema = "mid string, log_id int, ts long"
    first = visits.daily_actives(spark.createDataFrame([("a", 1, 100), ("a", 2, 50), ("b", 3, 86_400_000)], schema))
    assert rows(first, "mid", "logDate", "ts") == [("a", "1970-01-01", 50), ("b", "1970-01-02", 86_400_000)]
    second = visits.daily_actives(spark.createDataFrame([("a", 4, 7), ("c", 5, 7), ("b", 6, 8)], schema))
    assert rows(visits.not_seen(second, first), "mid") == [("b",), ("c",)]


def test_reports(spark):
    dau = spark.createDataFrame(
        [("d1", "00"), ("d1", "00"), ("d1", "13"), ("d2", "05")], "logDate string, logHour string"
    )
    assert rows(reports.dau_total(dau, "d1")) == [("d1", 3)]
    assert rows(reports.dau_hourly(dau)) == [("d1", "00", 2), ("d1", "13", 1), ("d2", "05", 1)]
    assert reports.dau_hourly_map(dau, "d1").first().hours == {"00": 2, "13": 1}
    assert rows(reports.kpis(dau, "d2"), "id", "value") == [("dau", 1)]


def test_first_and_latest(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("j", 1, "z")], "k string, s int, v string")
    assert rows(latest.first_by_key(df, ["k"], ["s"]), "k", "v") == [("j", "z"), ("k", "a")]
    assert rows(latest.latest_by_key(df, ["k"], ["s"]), "k", "v") == [("j", "z"), ("k", "c")]


def test_pages_say_themselves_whether_they_are_bounces(spark):
    """Every page once, marked as the search for bounces finds them; pages without device or time are none."""
    rng = random.Random(9)
    data = [(k, rng.choice(["a", "b", None]), None if k % 11 == 0 else k * 1_500 + rng.randrange(900), (rng.choice(["", None, "home"]),)) for k in range(300)]
    pages = spark.createDataFrame(data, "log_id long, mid string, ts long, page struct<last_page_id:string>").repartition(3)
    marked = visits.with_bounce(pages, timedelta(seconds=5))
    assert rows(marked, "log_id") == rows(pages, "log_id")
    assert rows(marked.where("bounced"), "log_id") == rows(visits.user_jumps(pages, timedelta(seconds=5)), "log_id") != []
