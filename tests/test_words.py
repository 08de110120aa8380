"""Smart segmentation against all ways through short runs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import words
from millrace.plans.catalogue import QUERIES
from tests.conftest import SMALL, rows


def brute(run, listed):
    """The best of all ways: most characters in words, fewest pieces, longer pieces first."""
    units = re.findall(r"[a-z0-9]+|\w", run)

    def ways(k):
        if k == len(units):
            yield []
        for n in range(1, len(units) - k + 1):
            piece = "".join(units[k:k + n])
            if piece in listed or n == 1:
                for rest in ways(k + n):
                    yield [(piece, n, piece in listed), *rest]

    best = max(ways(0), key=lambda w: (sum(len(p) for p, _, hit in w if hit), -len(w), [n for _, n, _ in w]))
    return [p for p, _, _ in best]


def cut(spark, runs, listed, **kw):
    table = spark.createDataFrame([(w,) for w in listed], "word string")
    df = words.segmented(spark.createDataFrame([(r,) for r in runs], "run string"), table, **kw)
    return {r.run: r.words for r in df.collect()}


def test_the_greedy_cut_is_not_taken(spark):
    listed = ["茶杯", "茶杯架", "架子", "绿茶", "杯"]
    # the longest word first would leave the last letter alone
    assert cut(spark, ["茶杯架子"], listed) == {"茶杯架子": ["茶杯", "架子"]}
    assert cut(spark, ["绿茶杯"], listed)["绿茶杯"] == ["绿茶", "杯"]


def test_equals_all_ways(spark):
    rng = random.Random(9)
    letters = "深空灰色移动"
    listed = {"".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(60)} | {"5g手", "手x"}
    runs = {"".join(rng.choice([*letters, "手", "x", "5g"]) for _ in range(rng.randint(1, 9))) for _ in range(150)}
    assert cut(spark, [*runs, *runs], sorted(listed)) == {r: brute(r, listed) for r in runs}


def test_odd_input(spark):
    assert cut(spark, [None, "ab12深", "AB12深"], []) == {"ab12深": ["ab12", "深"]}
    assert cut(spark, ["深"], [None, "", "深 空", "深"]) == {"深": ["深"]}
    assert cut(spark, [], ["深"]) == {}


def test_a_long_run_is_cut_in_stretches(spark):
    run = "深空灰色" * 5000
    assert cut(spark, [run], ["深空", "空灰", "灰色"]) == {run: ["深空", "灰色"] * 5000}


def test_words_of_texts_in_order(spark):
    df = spark.createDataFrame([(1, "绿茶杯 NEW 茶杯架子"), (2, None), (3, " ,"), (4, "绿茶杯 NEW 茶杯架子")], "i int, t string")
    table = spark.createDataFrame([("绿茶",), ("茶杯",), ("架子",)], "w string")
    got = {r.i: r.words for r in words.smart_words(df, "t", table, "w").collect()}
    assert got == {1: ["绿茶", "杯", "new", "茶杯", "架子"], 2: None, 3: [], 4: got[1]}
    assert rows(words.word_counts(df, "t", table, "w")) == sorted([("绿茶", 2), ("杯", 2), ("new", 2), ("茶杯", 2), ("架子", 2)], key=str)


def test_keyword_searches(spark):
    table = spark.createDataFrame([("绿茶",), ("茶杯",)], "word string")
    pages = spark.createDataFrame(
        [("search", "keyword", "绿茶茶杯", 5), ("home", "keyword", "绿茶", 6), ("search", "keyword", None, 7)], "l string, k string, item string, ts long"
    ).select(F.struct(F.col("l").alias("last_page_id"), F.col("k").alias("item_type"), "item").alias("page"), "ts")
    assert rows(words.keyword_searches(pages, table)) == sorted([("绿茶", 5), ("茶杯", 5)], key=str)


@pytest.mark.parametrize("size", [1, 3000])
def test_the_dictionary_stays_on_the_executors(spark, size):
    """The plan does not grow with the dictionary."""
    table = spark.range(size).select(F.concat(F.lit("深"), F.col("id").cast("string")).alias("word"))
    df = words.segmented(spark.createDataFrame([("深1",)], "run string"), table)
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 30_000


def test_texts_are_searched_for_runs_once(spark):
    """The dictionary and the runs of tokenize_smart come from one count, whose shuffle is used again."""
    df = QUERIES["tokenize_smart"](spark, SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1


def test_short_runs_are_one_stretch(spark, monkeypatch):
    """Whole or in stretches, a run is cut the same way."""
    rng = random.Random(4)
    listed = sorted({"".join(rng.choices("深空灰色移", k=rng.randint(1, 5))) for _ in range(50)})
    runs = {"".join(rng.choices("深空灰色移x5", k=rng.randint(1, 40))) for _ in range(80)}
    whole = cut(spark, runs, listed)
    monkeypatch.setattr(words, "WHOLE", 3)
    assert cut(spark, runs, listed) == whole
