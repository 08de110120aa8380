"""Visits, daily actives, visitor statistics, alerts, latest rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.operators import alerts, latest, logs, reports, stats, visits
from millrace.plans.inputs import DAU_SQL, E_SQL, LOGS_SQL, PAGES_SQL, Tables
from millrace.plans.registry import query
from millrace.schemas import LOG_LINE

# The test events are hours apart per device, so the widths are too.
JUMP_WITHIN = timedelta(hours=6)

_VISIT_SQL = """visits AS (
    SELECT * FROM pages WHERE coalesce(last_page_id, '') = ''
    QUALIFY row_number() OVER (PARTITION BY mid, ts // 86400000 ORDER BY ts, CAST(log_id AS BIGINT)) = 1)"""

_JUMP_SQL = f"""jumps AS (
    SELECT * FROM (
        SELECT *, lead(ts) OVER w AS next_ts, coalesce(lead(last_page_id) OVER w, '') = '' AS next_entry
        FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, CAST(log_id AS BIGINT)))
    WHERE coalesce(last_page_id, '') = ''
      AND (next_ts IS NULL OR next_ts - ts >= {JUMP_WITHIN // timedelta(milliseconds=1)} OR next_entry))"""


def _logs(t: Tables, *page_fields: str):
    """Log records, with all fields or with those of the page alone that are named."""
    schema = logs.only(*page_fields) if page_fields else LOG_LINE
    # The tiebreak is a number in the test data; as text it would sort differently.
    return logs.parse_logs(t.log_lines(), schema=schema).withColumn("log_id", F.col("log_id").cast("long"))


def _pages(t: Tables, *page_fields: str):
    return logs.page_logs(_logs(t, *page_fields))


@query("is_new_repair", f"""
    WITH {LOGS_SQL}
    SELECT CAST(log_id AS BIGINT) AS log_id, mid, ts,
           CASE WHEN is_new = '1' AND
               row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, CAST(log_id AS BIGINT)) > 1
               THEN '0' ELSE is_new END AS is_new
    FROM logs""")
def is_new_repair(t: Tables):
    return visits.repair_is_new(_logs(t, "page_id").select("log_id", "mid", "ts", "is_new"))


@query("unique_visit", f"""
    WITH {PAGES_SQL}, {_VISIT_SQL} SELECT CAST(log_id AS BIGINT) AS log_id, mid, page_id, ts FROM visits""")
def unique_visit(t: Tables):
    return visits.unique_visits(_pages(t, "page_id", "last_page_id")).select("log_id", "mid", "page.page_id", "ts")


@query("user_jump", f"""
    WITH {PAGES_SQL}, {_JUMP_SQL} SELECT CAST(log_id AS BIGINT) AS log_id, mid, page_id, ts FROM jumps""")
def user_jump(t: Tables):
    return visits.user_jumps(_pages(t, "page_id", "last_page_id"), JUMP_WITHIN).select("log_id", "mid", "page.page_id", "ts")


@query("visitor_stats", f"""
    WITH {PAGES_SQL}, {_VISIT_SQL}, {_JUMP_SQL}, rows AS (
        SELECT vc, ch, ar, is_new, ts, 0 AS uv, 1 AS pv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv,
               0 AS uj, during_time AS dur FROM pages
        UNION ALL SELECT vc, ch, ar, is_new, ts, 1, 0, 0, 0, 0 FROM visits
        UNION ALL SELECT vc, ch, ar, is_new, ts, 0, 0, 0, 1, 0 FROM jumps)
    SELECT strftime(time_bucket(INTERVAL 1 DAY, make_timestamp(ts * 1000)), '%Y-%m-%d %H:%M:%S') AS stt,
           strftime(time_bucket(INTERVAL 1 DAY, make_timestamp(ts * 1000)) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS edt,
           vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
           CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct,
           CAST(sum(dur) AS BIGINT) AS dur_sum, max(ts) AS ts
    FROM rows GROUP BY ALL""")
def visitor_stats(t: Tables):
    # Bounces are marked on the pages; only the first visits need a second, narrow look at the lines.
    pages = visits.with_bounce(_pages(t, "last_page_id", "during_time"), JUMP_WITHIN)
    return stats.visitor_stats(pages, visits.unique_visits(_pages(t, "last_page_id")), window="1 day")


def _dau(t: Tables):
    return visits.daily_actives(t.startup_logs())


@query("dau", f'WITH {DAU_SQL} SELECT log_id, mid, ch, ts, "logDate", "logHour" FROM dau')
def dau(t: Tables):
    return _dau(t)


@query("dau_first_per_key", f"""
    WITH {E_SQL}
    SELECT event_type AS ch, event_id AS log_id, ms AS ts FROM e
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ms, event_id) = 1""")
def dau_first_per_key(t: Tables):
    # Five keys hold all rows: each input partition sends one row per key.
    return latest.first_by_key(t.startup_logs(), ["ch"], ["ts", "log_id"]).select("ch", "log_id", "ts")


@query("dau_anti_join", f"""
    WITH {E_SQL}, d AS (
        SELECT event_id, user_id, event_type, ms, strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS "logDate" FROM e)
    SELECT event_id AS log_id, user_id AS mid, "logDate" FROM d
    WHERE event_type <> 'signup' AND NOT EXISTS (
        SELECT 1 FROM d AS s WHERE s.event_type = 'signup' AND s.user_id = d.user_id AND s."logDate" = d."logDate")
    QUALIFY row_number() OVER (PARTITION BY user_id, "logDate" ORDER BY ms, event_id) = 1""")
def dau_anti_join(t: Tables):
    logs_ = t.startup_logs()
    seen = visits.with_log_time(logs_.where(F.col("ch") == "signup"))
    fresh = visits.daily_actives(logs_.where(F.col("ch") != "signup"))
    return visits.not_seen(fresh, seen).select("log_id", "mid", "logDate")


@query("dau_total", f'WITH {DAU_SQL} SELECT "logDate", count(*) AS total FROM dau GROUP BY 1')
def dau_total(t: Tables):
    return reports.dau_total(_dau(t))


@query("dau_hourly", f'WITH {DAU_SQL} SELECT "logDate", "logHour", count(*) AS ct FROM dau GROUP BY 1, 2')
def dau_hourly(t: Tables):
    return reports.dau_hourly(_dau(t))


@query("dau_hourly_map", f"""
    WITH {DAU_SQL}, h AS (SELECT "logDate", "logHour", count(*) AS ct FROM dau GROUP BY 1, 2)
    SELECT "logDate", '{{' || string_agg('"' || "logHour" || '":' || ct, ',' ORDER BY "logHour") || '}}' AS hours
    FROM h GROUP BY 1""")
def dau_hourly_map(t: Tables):
    return reports.dau_hourly_map(_dau(t)).select("logDate", F.to_json("hours").alias("hours"))


@query("kpi_dau", f"""
    WITH {DAU_SQL}
    SELECT "logDate", 'dau' AS id, '{reports.DAU_KPI[1]}' AS name, count(*) AS value FROM dau GROUP BY 1""")
def kpi_dau(t: Tables):
    return reports.kpis(_dau(t))


_ALERT_SQL = E_SQL + """, d AS (
    SELECT CAST(user_id AS VARCHAR) AS mid, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS uid,
           CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem' ELSE event_type END AS evid,
           CAST(k AS VARCHAR) AS itemid, ms AS ts,
           time_bucket(INTERVAL 12 HOUR, make_timestamp(ms * 1000), TIMESTAMP '1970-01-01') AS pane
    FROM e), w AS (
    SELECT *, pane AS start FROM d UNION ALL SELECT *, pane - INTERVAL 12 HOUR FROM d), hits AS (
    SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS stt,
           strftime(start + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS edt, mid,
           count(DISTINCT CASE WHEN evid = 'coupon' THEN uid END) AS uid_ct, count(*) AS event_ct, max(ts) AS ts
    FROM w GROUP BY 1, 2, 3
    HAVING uid_ct >= 2 AND count(CASE WHEN evid = 'clickItem' THEN 1 END) = 0)"""

_ALERT = {"window": "1 day", "slide": "12 hours"}


def _alerts(t: Tables):
    return alerts.coupon_alerts(t.device_events(), min_users=2, **_ALERT)


@query("coupon_alert", f"WITH {_ALERT_SQL} SELECT stt, edt, mid, uid_ct, event_ct, ts FROM hits")
def coupon_alert(t: Tables):
    return _alerts(t)


@query("coupon_alert_evidence", f"""
    WITH {_ALERT_SQL}, facts AS (
        SELECT start, mid, 'event' AS kind, evid AS value FROM w
        UNION ALL SELECT start, mid, 'uid', uid FROM w WHERE evid = 'coupon'
        UNION ALL SELECT start, mid, 'item', itemid FROM w WHERE evid = 'coupon')
    SELECT hits.stt, hits.edt, hits.mid, kind, value, count(*) AS ct
    FROM facts JOIN hits ON hits.mid = facts.mid AND hits.stt = strftime(start, '%Y-%m-%d %H:%M:%S')
    GROUP BY ALL""")
def coupon_alert_evidence(t: Tables):
    return alerts.alert_evidence(_alerts(t), t.device_events(), **_ALERT)


@query("coupon_alert_throttled", f"""
    WITH {_ALERT_SQL}
    SELECT mid || CAST(ts // 60000 AS VARCHAR) AS doc_id, mid, stt, edt, uid_ct, event_ct, ts FROM hits
    QUALIFY row_number() OVER (PARTITION BY mid, ts // 60000 ORDER BY ts DESC, stt DESC) = 1""")
def coupon_alert_throttled(t: Tables):
    return alerts.throttled(_alerts(t))


@query("dim_latest", f"""
    WITH {E_SQL}
    SELECT user_id AS id, event_id, event_type, k FROM e
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) = 1""")
def dim_latest(t: Tables):
    rows = t.events().withColumnRenamed("user_id", "id")
    return latest.latest_by_key(rows, ["id"], ["ms", "event_id"]).select("id", "event_id", "event_type", "k")


@query("dim_upsert_columns", f"""
    WITH {E_SQL},
    every AS (
        SELECT user_id, k FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) = 1),
    clicked AS (
        SELECT user_id, event_id FROM e WHERE event_type = 'click'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) = 1)
    SELECT user_id AS id, CAST(k AS VARCHAR) AS k, CAST(event_id AS VARCHAR) AS last_click
    FROM every LEFT JOIN clicked USING (user_id)""")
def dim_upsert_columns(t: Tables):
    """Events as partial updates of a user: all set ``k``, only clicks set ``last_click``."""
    carried = F.create_map(
        F.lit("k"), F.col("k").cast("string"),
        F.lit("last_click"), F.when(F.col("event_type") == "click", F.col("event_id").cast("string")))
    rows = t.events().select(
        F.col("user_id").alias("id"), F.map_filter(carried, lambda name, value: (name != "last_click") | value.isNotNull()).alias("image"), "ms", "event_id")
    found = latest.latest_by_column(rows, ["id"], "image", ["ms", "event_id"])
    return found.select("id", *[F.try_element_at("image", F.lit(c)).alias(c) for c in ("k", "last_click")])


@query("user_latest", f"""
    WITH {E_SQL}
    SELECT CAST(user_id AS VARCHAR) AS id, event_type AS user_level, CAST(k AS VARCHAR) AS login_name FROM e
    WHERE event_type IN ('signup', 'view')
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) = 1""")
def user_latest(t: Tables):
    # Sign-ups and views stand for user inserts and updates.
    rows = t.events().where(F.col("event_type").isin("signup", "view"))
    return latest.latest_by_key(rows, ["user_id"], ["ms", "event_id"]).select(
        F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("user_level"),
        F.col("k").cast("string").alias("login_name"),
    )
