"""Shapes of the physical plans, and behaviour under a key that holds a third of the rows."""

from contextlib import contextmanager
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from millrace.operators import joins, latest, logs, stats, visits
from millrace.plans.catalogue import QUERIES
from tests.conftest import SMALL, rows

N = 60_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def conf(spark, **settings):
    old = {}
    for key, value in settings.items():
        key = "spark.sql." + key.replace("__", ".")
        old[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def no_broadcast(spark):
    return conf(
        spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB", adaptive__advisoryPartitionSizeInBytes="64KB",
        shuffle__partitions="32", adaptive__coalescePartitions__enabled="false",
    )


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Rows of which a third share the key 0, in many files."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    (
        spark.range(0, N, 1, 12)
        .select(
            F.when(F.col("id") < N // 3, 0).otherwise(F.col("id") % 2_000 + 1).alias("k"), "id",
            F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("pad"),
        )
        .orderBy(F.xxhash64("id"))
        .write.parquet(path)
    )
    return path


@pytest.fixture
def keys(spark):
    return spark.range(0, 2_001).select(F.col("id").alias("dk"), (F.col("id") * 10).alias("v"))


def skew_split(df):
    df.collect()
    return "skew=true" in plan_of(df)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_dimension_join_splits_a_hot_key(spark, hot, keys, how):
    with no_broadcast(spark):
        spec = joins.DimSpec("d", "k", {"v": "v"}, dim_key="dk", how=how)
        df = joins.enrich(spark.read.parquet(hot), {"d": keys}, [spec])
        assert skew_split(df)
        assert df.agg(F.count("*"), F.sum("v")).first()[0] == N


def test_full_outer_join_splits_a_hot_key(spark, hot, keys):
    with no_broadcast(spark):
        df = joins.full_outer_join(keys, spark.read.parquet(hot), "dk", "k")
        assert skew_split(df) and df.count() == N
        native = keys.join(spark.read.parquet(hot), F.col("dk") == F.col("k"), "full")
        assert not skew_split(native)


def test_interval_join_spreads_a_hot_key(spark, hot):
    """A key that is hot on both sides meets cell by cell, in several tasks."""
    side = spark.read.parquet(hot).drop("pad")
    left = side.where("k = 0").select("k", "id", F.timestamp_seconds("id").alias("lt"))
    right = side.where("k = 0").select(F.col("k").alias("rk"), F.col("id").alias("rid"), F.timestamp_seconds("id").alias("rt"))
    with no_broadcast(spark):
        df = joins.interval_join(
            left, right, left_key="k", right_key="rk", left_time="lt", right_time="rt",
            lower=timedelta(seconds=-1), upper=timedelta(seconds=1),
        )
        n = N // 3
        assert df.count() == 3 * n - 2
        assert df.groupBy(F.spark_partition_id()).count().count() > 1


def test_first_of_a_hot_key_is_cut_before_the_shuffle(spark, hot):
    df = latest.first_by_key(spark.read.parquet(hot), ["k"], ["id"])
    text = plan_of(df)
    assert "WindowGroupLimit" in text and "Partial" in text
    assert df.where("k = 0").first().id == 0 and df.count() == 2_001


def test_jumps_of_a_hot_device_run_in_many_groups(spark, hot):
    pages = spark.read.parquet(hot).select(
        F.col("k").cast("string").alias("mid"), F.col("id").alias("log_id"), (F.col("id") * 3_000).alias("ts"),
        F.struct(F.when(F.col("id") % 2 == 0, "x").alias("last_page_id")).alias("page"),
    )
    cells = visits.look_ahead(pages, F.col("ts"), timedelta(seconds=10))
    biggest = cells.groupBy("mid", "_cell").count().agg(F.max("count")).first()[0]
    assert biggest < 50 and cells.count() < 1.2 * N
    # An odd page of the hot device is followed 3 s later by an even one, which has a previous page.
    hot_ = visits.user_jumps(pages.where("mid = '0'"))
    assert hot_.count() == 1 and hot_.first().log_id == N // 3 - 1


def test_repair_of_a_hot_device(spark, hot):
    claims = spark.read.parquet(hot).select(
        F.col("k").cast("string").alias("mid"), F.col("id").alias("log_id"), (F.col("id") * 10).alias("ts"),
        F.lit("1").alias("is_new"),
    )
    with no_broadcast(spark):
        df = visits.repair_is_new(claims)
        assert "hashpartitioning(mid" in plan_of(df)
        assert rows(df.groupBy("is_new").count()) == [("0", N - 2_001), ("1", 2_001)]
        # The rows are spread by (device, time), not by device.
        tasks = df.where("mid = '0'").groupBy(F.spark_partition_id()).agg(F.count("*").alias("ct"), F.max("is_new"))
        assert max(r.ct for r in tasks.collect()) < N // 20


def test_distinct_orders_of_a_hot_group_are_reduced_first(spark, hot):
    wide = spark.read.parquet(hot).select(
        F.lit(7).alias("province_id"), F.col("k").alias("order_id"), F.lit("1.00").cast("decimal(16,2)").alias("split_total_amount"),
        F.timestamp_seconds(F.lit(100)).alias("create_time"),
    )
    df = stats.province_stats(wide, keys=["province_id"])
    assert df.first().order_count == 2_001
    assert plan_of(df).count("partial_") >= 2


def test_a_line_is_parsed_once(spark, lines):
    pages = logs.page_logs(logs.parse_logs(lines('{"page": {"page_id": "a"}, "ts": 1}')))
    df = visits.unique_visits(pages).where("mid = 'a'")
    text = plan_of(df)
    # two reads of the parsed value: the mark and the record
    assert text.count("parseJson") == 1 and text.count("try_variant_get") == 2 and "from_json" not in text


@pytest.mark.parametrize("name, scans", [("parse_clean", 1), ("log_display", 1), ("unique_visit", 1), ("is_new_repair", 2), ("visitor_stats", 2)])
def test_a_derived_line_is_printed_and_parsed_once_a_scan(spark, name, scans):
    text = plan_of(contract.queries()[name](spark, SMALL)).split("== Initial Plan ==")[0]
    assert text.count("parseJson") == text.count("StructsToJsonEvaluator") == text.count("FileScan") == scans


def test_province_stats_reads_only_its_columns(spark):
    text = plan_of(contract.queries()["province_stats"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text


def below(text, node):
    """Lines of the plan below the first line that names ``node``."""
    lines = text.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    at = next(k for k, line in enumerate(lines) if node in line)
    end = next((k for k in range(at + 1, len(lines)) if depth(lines[k]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at:end]), "\n".join(lines[:at] + lines[end:])


def test_dimensions_are_joined_after_the_aggregation(spark):
    text = plan_of(contract.queries()["product_stats"](spark, SMALL)).split("== Initial Plan ==")[0]
    inside, outside = below(text, "HashAggregate")
    assert "part.parquet" not in inside and "part.parquet" in outside
    assert 1 <= inside.count("FileScan") and inside.count("lineitem.parquet") <= 2 and "lineitem.parquet" not in outside


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything(spark, name):
    text = plan_of(contract.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text
