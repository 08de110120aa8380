import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import codes, moments, sql, text
from millrace.operators import search
from millrace.sources.tables import camel_columns, jdbc_options
from tests.conftest import rows

PHONE = "Kettle ProBoil3 (K77) 900ML 墨绿色 快煮静音保温2L水壶 防干烧"


def words(spark, value, **kw):
    return spark.createDataFrame([(value,)], "t string").select(text.tokenize("t", **kw)).first()[0]


def test_words(spark):
    assert words(spark, PHONE) == [
        "kettle", "proboil3", "k77", "900ml", "墨绿色", "快煮静音保温2l水壶", "防干烧",
    ]
    assert words(spark, None) is None and words(spark, " ,!") == []


def test_words_in_sql(spark):
    sql.register(spark)
    spark.createDataFrame([(1, "Red TEA"), (2, None), (3, "深空 x1")], "i int, s string").createOrReplaceTempView("texts")
    df = spark.sql("SELECT i, word FROM texts, LATERAL words(s)")
    assert rows(df) == [(1, "red"), (1, "tea"), (3, "x1"), (3, "深空")]
    assert spark.sql("SELECT word_list('A b')").first()[0] == ["a", "b"]


def test_dictionary_takes_the_longest_word(spark):
    known = ["墨绿", "墨绿色", "快煮", "静音", "保温", "水壶", "防干烧"]
    assert words(spark, PHONE, words=known)[4:] == ["墨绿色", "快煮", "静音", "保温", "2l", "水壶", "防干烧"]
    assert words(spark, "绿a绿", words=known) == ["绿", "a", "绿"]


@pytest.mark.parametrize("size", [3, 450, 501, 5000])
def test_dictionaries_of_any_size_cut_by_the_longest_word(spark, size):
    rng = random.Random(size)
    letters = "深空灰色移动联通电信手机双卡待ab4é-"
    wide = letters if size < 1000 else letters + "".join(chr(0x4E00 + k) for k in range(600))
    known = {"".join(rng.choices(wide, k=rng.randint(1, 4))) for _ in range(size)}

    def cut(line):
        out, at = [], 0
        while at < len(line):
            found = max((line[at:at + n] for n in range(1, 5) if line[at:at + n] in known), key=len, default=None)
            found = found or (re.match("[a-z0-9]+", line[at:]) or re.match(r"\w?", line[at:])).group()
            out += [found] if found else []
            at += len(found) or 1
        return out

    lines = ["".join(rng.choices(wide + " ,.", k=40)) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in [*lines, None, ""]], "t string")
    got = {r.t: r.words for r in df.select("t", text.tokenize("t", known).alias("words")).collect()}
    assert got == {t: cut(t) for t in lines} | {None: None, "": []}


def test_letters_are_the_same_whatever_the_list(spark):
    """One letter class, also for code points that were letters only in some Unicode versions."""
    df = spark.range(0x860, 0x8A0).select(F.chr("id").alias("c")).where("false").unionByName(
        spark.createDataFrame([(chr(c),) for c in (*range(0x860, 0x8A0), 0x1F600, 0x41, 0x2460)], "c string"))
    few, many = text.tokenize("c", ["zz"]), text.tokenize("c", [f"zz{k}" for k in range(900)])
    assert df.where(~few.eqNullSafe(many)).count() == 0


def test_names():
    assert text.camel_case("tm_name") == "tmName" and text.camel_case("id") == "id"


def test_camel_columns(spark):
    assert camel_columns(spark.range(1).toDF("order_total_amount")).columns == ["orderTotalAmount"]
    assert jdbc_options("u", "select 1", "d") == {"url": "u", "query": "select 1", "fetchsize": "10000", "driver": "d"}


def test_code_labels(spark):
    df = spark.createDataFrame([("1001",), ("1006",), ("9",), (None,)], "c string")
    got = [r[0] for r in df.select(codes.code_label("order_status", "c")).collect()]
    assert got == ["unpaid", "refunded", None, None]
    every = [code for table in codes.CODES.values() for code in table]
    assert len(every) == len(set(every))


def test_moments(spark):
    row = spark.createDataFrame([(1_608_533_536_999, "2021-03-01 09:08:07", "x")], "ms long, t string, bad string").select(
        moments.to_wall_clock(moments.from_millis("ms")).alias("a"),
        F.unix_millis(moments.from_millis_whole_seconds("ms")).alias("b"),
        moments.day_of_text("t").alias("c"), moments.hour_of_text("t").alias("d"),
        F.unix_millis(moments.from_wall_clock("t")).alias("e"), moments.from_wall_clock("bad").alias("f"),
        moments.minute_bucket("ms").alias("g"),
    ).first()
    assert tuple(row) == ("2020-12-21 06:52:16", 1_608_533_536_000, "2021-03-01", "09", 1_614_589_687_000, None, 26_808_892)


DOCS = [
    ("1001", "a", 1, 20, "篮球,滑冰"), ("1002", "b", 1, 25, "唱歌"), ("1003", "c", 2, 17, "篮球"),
    ("1004", "d", 1, 30, "篮球,篮球"), ("1005", "e", 1, 22, None),
]


def test_search(spark):
    docs = spark.createDataFrame(DOCS, "id string, name string, sex int, age int, favo string")
    hits = search.search(docs, {"sex": 1}, "favo", "篮球")
    assert rows(hits, "id", "score") == [("1001", 1), ("1004", 2)]
    assert search.hit_total(hits).first().total == 2
    assert [r.id for r in search.page_of(hits, "id", 1).collect()] == ["1004"]
    assert [r.id for r in search.page_of(hits, "id", 1, 1).collect()] == ["1001"]
    assert [tuple(r) for r in search.top_terms(hits, "id", maxAge=F.max("age")).collect()] == [("1001", 1, 20), ("1004", 1, 30)]
