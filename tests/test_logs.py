import json

from pyspark.sql import functions as F

from millrace.operators import logs
from millrace.sources.feeds import records, register
from tests.conftest import rows

PAGE = {
    "common": {"mid": "dev-9", "vc": "v7", "ch": "store", "ar": "42", "is_new": "1"},
    "page": {
        "page_id": "good_detail", "last_page_id": "good_list", "item": "77", "item_type": "sku_id",
        "during_time": 812, "source_type": "query",
    },
    "displays": [{"item": "5", "item_type": "sku_id"}, {"item": 6, "item_type": "activity_id"}],
    "ts": 1700000000123,
}
START = {"common": {"mid": "dev-9", "is_new": "1"}, "start": {"entry": "icon"}, "ts": 1700000000000}


def test_clean_and_dirty(lines):
    df = lines(json.dumps(PAGE), json.dumps(START), "not json at all", "", "[]", "7", '{"ts": 1', None, "  {}")
    assert logs.parse_clean(df).count() == 3
    assert sorted(str(r[0]) for r in logs.parse_dirty(df).collect()) == sorted(
        ["not json at all", "", "[]", "7", '{"ts": 1', "None"]
    )


def test_unexpected_value_types_do_not_make_a_line_dirty(lines):
    odd = {"common": {"mid": 17, "is_new": 1}, "page": {"during_time": "soon"}, "ts": "1700000000123"}
    row = logs.parse_logs(lines(json.dumps(odd))).first()
    assert (row.mid, row.is_new, row.page.during_time, row.ts) == ("17", "1", None, 1700000000123)


def test_three_way_split(lines):
    parsed = logs.parse_logs(lines(json.dumps(PAGE), json.dumps(START), '{"start": "", "page": {"page_id": "p"}}'))
    assert rows(logs.start_logs(parsed), "mid", "start") == [("dev-9", '{"entry":"icon"}')]
    assert rows(logs.page_logs(parsed), "page.page_id") == [("good_detail",), ("p",)]
    shown = logs.display_logs(parsed)
    assert shown.columns == ["page_id", "item", "item_type"]
    assert rows(shown) == [("good_detail", "5", "sku_id"), ("good_detail", "6", "activity_id")]


def test_entry_is_null_or_empty_but_session_is_null_only(lines):
    parsed = logs.parse_logs(
        lines('{"page": {}}', '{"page": {"last_page_id": ""}}', '{"page": {"last_page_id": "home"}}')
    )
    flags = parsed.select(
        F.col("page.last_page_id"), logs.is_entry().alias("e"), logs.starts_session().alias("s")
    )
    assert {tuple(r) for r in flags.collect()} == {(None, True, True), ("", True, False), ("home", False, False)}


def test_keyword_searches(lines):
    def search(item, last="search", kind="keyword"):
        return json.dumps({"page": {"item": item, "last_page_id": last, "item_type": kind}, "ts": 1})

    parsed = logs.parse_logs(lines(search("tea"), search(None), search("x", last="home"), search("x", kind="sku_id")))
    assert rows(parsed.where(logs.is_keyword_search()), "page.item", "ts") == [("tea", 1)]


def test_dirty_means_not_a_json_object(lines):
    shapes = ['{"common":"x","page":{"page_id":"p"}}', '{"page":"home","ts":3}', '{"displays":{"item":1}}', '{"ts":[1]}', "{}", '\t{"a":1}\n']
    broken = ['{"a":1} tail', '{"a":1}{"b":2}', "{'log_id':'1'}", "{a:1}", '{"a":NaN}', '{"a":1},{"b":2}', '{"a":1}] [', '{"a":1,}', '"text"', "null"]
    assert rows(logs.parse_dirty(lines(*shapes, *broken))) == sorted(((v,) for v in broken), key=str)
    parsed = logs.parse_logs(lines(*shapes)).collect()
    assert len(parsed) == len(shapes) and {r.page.page_id if r.page else None for r in parsed} == {"p", None} and {r.ts for r in parsed} == {3, None}


def test_numbers_may_come_as_text(lines):
    df = lines('{"id":"1","total_amount":"2.50","user_id":7}', '{"id":2,"total_amount":3,"user_id":"x"}', '{"id":{"a":1}}', "no")
    got = rows(records(df, "dwd_order_info"), "id", "total_amount", "user_id")
    assert sorted(((i, None if a is None else float(a), u) for i, a, u in got), key=str) == sorted([(1, 2.5, 7), (2, 3.0, None), (None, None, None)], key=str)


def test_feed_records_and_view(spark, lines):
    df = lines('{"sku_id": 3, "create_time": "2021-01-01 00:00:00"}', "broken")
    assert rows(records(df, "dwd_favor_info")) == [(3, "2021-01-01 00:00:00")]
    register(df, "dwd_favor_info", "favor")
    assert spark.sql("SELECT sku_id FROM favor").first()[0] == 3
