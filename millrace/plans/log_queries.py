"""Logs and change records."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import changes, logs
from millrace.plans.inputs import CHANGES_SQL, KEPT_SQL, LOGS_SQL, PAGES_SQL, ROUTE_NAMES, ROUTE_ROWS, Tables
from millrace.plans.registry import query

_CONFIG_SQL = f"""config({ROUTE_NAMES}) AS (VALUES {ROUTE_ROWS.replace("STRING", "VARCHAR")})"""


@query("parse_clean", f"""
    WITH {LOGS_SQL}
    SELECT log_id, mid, vc, ch, ar, is_new, page_id, last_page_id, item, during_time, ts FROM logs""")
def parse_clean(t: Tables):
    # A start line has no page record.
    return logs.parse_logs(t.log_lines()).select(
        "log_id", "mid", "vc", "ch", "ar", "is_new", "page.page_id", "page.last_page_id", "page.item",
        "page.during_time", "ts",
    )


@query("parse_dirty", '''
    SELECT CASE k % 5 WHEN 1 THEN '{"log_id":"' || event_id || '"} tail' WHEN 2 THEN '{"log_id":"' || event_id || '"}{"log_id":"0"}'
        WHEN 3 THEN '{' || chr(39) || 'log_id' || chr(39) || ':' || chr(39) || event_id || chr(39) || '}' ELSE 'error at ' || event_id END AS value
    FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'error')''')
def parse_dirty(t: Tables):
    return logs.parse_dirty(t.log_lines())


@query("log_start", f"""
    WITH {LOGS_SQL} SELECT log_id, mid, '{{"entry":"icon"}}' AS start, ts FROM logs WHERE is_start""")
def log_start(t: Tables):
    return logs.start_logs(logs.parse_logs(t.log_lines())).select("log_id", "mid", "start", "ts")


@query("log_page", f"""
    WITH {PAGES_SQL} SELECT log_id, mid, page_id, last_page_id, item_type, ts FROM pages""")
def log_page(t: Tables):
    return logs.page_logs(logs.parse_logs(t.log_lines())).select(
        "log_id", "mid", "page.page_id", "page.last_page_id", "page.item_type", "ts"
    )


@query("log_display", f"""
    WITH {PAGES_SQL}
    SELECT page_id, item, 'sku_id' AS item_type FROM pages WHERE page_id = 'good_detail'
    UNION ALL
    SELECT page_id, CAST(k + 1 AS VARCHAR), 'activity_id' FROM pages WHERE page_id = 'good_detail'""")
def log_display(t: Tables):
    return logs.display_logs(logs.parse_logs(t.log_lines()))


@query("cdc_parse", f"""
    WITH {CHANGES_SQL}
    SELECT 'shop' AS database, "tableName", "type",
           CASE WHEN "type" <> 'delete' THEN id END AS id, CASE WHEN "type" <> 'delete' THEN k END AS k,
           CASE WHEN "type" IN ('update', 'delete') THEN id END AS before_id,
           CAST(CASE WHEN "type" <> 'delete' THEN 3 ELSE 0 END AS BIGINT) AS fields
    FROM changes""")
def cdc_parse(t: Tables):
    rows = changes.decode_connect(t.connect_records())
    return rows.select(
        "database", "tableName", "type", F.col("data")["id"].alias("id"), F.col("data")["k"].alias("k"),
        F.col("before")["id"].alias("before_id"), F.size("data").alias("fields"),
    )


@query("cdc_filter", f"""
    WITH {KEPT_SQL}
    SELECT "tableName", "type", CASE WHEN "type" <> 'delete' THEN id END AS id,
           CAST(CASE WHEN "type" <> 'delete' THEN 3 ELSE 0 END AS BIGINT) AS fields
    FROM kept""")
def cdc_filter(t: Tables):
    rows = changes.with_after_image(changes.parse_changes(t.change_lines()))
    return rows.select("tableName", "type", F.col("data")["id"].alias("id"), F.size("data").alias("fields"))


@query("cdc_route_static", f"""
    WITH {KEPT_SQL}
    SELECT "tableName" AS topic, '{{"id":"' || id || '","user_id":"' || user_id || '","k":"' || k || '"}}' AS value
    FROM kept
    WHERE ("tableName" IN ('order_info', 'order_detail') AND "type" = 'insert')
       OR ("tableName" = 'user_info' AND "type" IN ('insert', 'update'))""")
def cdc_route_static(t: Tables):
    rows = changes.with_after_image(changes.parse_changes(t.change_lines()))
    return changes.route_static(rows).select("topic", "value")


def _routed(t: Tables):
    rows = changes.with_after_image(changes.parse_changes(t.change_lines()))
    return changes.route_by_config(rows, t.routes())


@query("cdc_route_dynamic", f"""
    WITH {KEPT_SQL}, {_CONFIG_SQL}
    SELECT sinkType AS sink_type, sinkTable AS sink_table, coalesce(sinkPk, 'id') AS pk,
           coalesce(sinkExtend, '') AS extend, count(*) AS ct,
           count(CASE WHEN "type" <> 'delete' AND list_contains(string_split(sinkColumns, ','), 'id') THEN 1 END) AS ids
    FROM kept JOIN config ON "tableName" = sourceTable AND "type" = operateType
    WHERE sinkType IN ('kafka', 'hbase')
    GROUP BY ALL""")
def cdc_route_dynamic(t: Tables):
    return (
        _routed(t)
        .groupBy(
            F.col("sinkType").alias("sink_type"), F.col("sinkTable").alias("sink_table"),
            F.col("sinkPk").alias("pk"), F.col("sinkExtend").alias("extend"),
        )
        .agg(F.count("*").alias("ct"), F.count(F.col("data")["id"]).alias("ids"))
    )


@query("cdc_prune_columns", f"""
    WITH {KEPT_SQL}, {_CONFIG_SQL}
    SELECT sinkTable AS sink_table,
           CASE sinkColumns WHEN 'id,user_id' THEN '{{"id":"' || id || '","user_id":"' || user_id || '"}}'
               WHEN 'user_id' THEN '{{"user_id":"' || user_id || '"}}'
               ELSE '{{"id":"' || id || '","k":"' || k || '"}}' END AS data
    FROM kept JOIN config ON "tableName" = sourceTable AND "type" = operateType
    WHERE sinkType IN ('kafka', 'hbase')""")
def cdc_prune_columns(t: Tables):
    return _routed(t).select(F.col("sinkTable").alias("sink_table"), F.to_json("data").alias("data"))
