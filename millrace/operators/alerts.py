"""Coupon-abuse alerts: many users taking coupons on one device without browsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.moments import from_millis, minute_bucket, with_window_bounds

COUPON, CLICK = "coupon", "clickItem"
# What names an alert.
_ALERT = ["stt", "edt", "mid"]


def coupon_alerts(
    events: DataFrame,
    window: str = "5 minutes",
    slide: str | None = "1 minute",
    min_users: int = 3,
    delay: str | None = None,
    coupon: str = COUPON,
    click: str = CLICK,
) -> DataFrame:
    """Devices and windows with ``min_users`` distinct coupon takers and no click.

    One row per alert with the counts.  Events are first reduced to one row per
    (pane of one slide, device, user); only these are copied into the sliding
    windows.  Users are then counted as rows, so a hot device is spread over its
    users and a raw event is never multiplied.
    """
    taker = F.when(F.col("evid") == coupon, F.col("uid"))
    rows = _timed(events, delay).select(
        "event_time", "mid", taker.alias("taker"), "ts",
        F.when(F.col("evid") == click, 1).otherwise(0).alias("clicked"),
    )
    totals = [F.max("clicked").alias("clicked"), F.sum("event_ct").alias("event_ct"), F.max("ts").alias("ts")]
    per_user = _sliding(
        rows.withColumn("event_ct", F.lit(1)), ["mid", "taker"], totals, window, slide
    )
    per_device = per_user.groupBy("window", "mid").agg(F.count("taker").alias("uid_ct"), *totals)
    hits = per_device.where((F.col("uid_ct") >= min_users) & (F.col("clicked") == 0)).drop("clicked")
    return with_window_bounds(hits)


def _timed(events: DataFrame, delay: str | None) -> DataFrame:
    rows = events.withColumn("event_time", from_millis("ts"))
    return rows.withWatermark("event_time", delay) if delay else rows


def _sliding(rows: DataFrame, keys: list, totals: list, window: str, slide: str | None) -> DataFrame:
    """Aggregate by sliding window through panes of one slide (re-aggregable totals)."""
    if slide is None or slide == window:
        return rows.groupBy(F.window("event_time", window), *keys).agg(*totals)
    panes = rows.groupBy(F.window("event_time", slide).alias("pane"), *keys).agg(*totals)
    return panes.groupBy(F.window("pane", window, slide).alias("window"), *keys).agg(*totals)


def alert_evidence(
    alerts: DataFrame,
    events: DataFrame,
    window: str = "5 minutes",
    slide: str | None = "1 minute",
    coupon: str = COUPON,
) -> DataFrame:
    """What the alerts rest on, in long form: ``kind`` uid, item or event, value and count.

    The users, the items and the event list of an alert are each a set of rows
    with counts; no list grows with the traffic of a device.  Only the events of devices that have an
    alert are counted.
    """
    events = events.join(alerts.select("mid").distinct(), "mid", "left_semi")
    if slide is None or slide == window:
        counted = _facts(events, coupon).groupBy(F.window("event_time", window), "mid", "kind", "value").agg(F.count("*").alias("ct"))
        return with_window_bounds(counted).join(alerts.select(*_ALERT), _ALERT, "left_semi")
    return evidence_of_panes(alerts, evidence_panes(events, slide, coupon), window, slide)


def _facts(events: DataFrame, coupon: str) -> DataFrame:
    """``event_time, mid, kind, value``: what each event is evidence of."""
    took = F.col("evid") == coupon
    facts = F.array(
        F.struct(F.lit("event").alias("kind"), F.col("evid").alias("value")),
        F.struct(F.lit("uid").alias("kind"), F.when(took, F.col("uid")).alias("value")),
        F.struct(F.lit("item").alias("kind"), F.when(took, F.col("itemid")).alias("value")),
    )
    rows = _timed(events, None).where(F.col("mid").isNotNull() & F.col("event_time").isNotNull())
    return rows.select("event_time", "mid", F.inline(facts)).where(F.col("value").isNotNull())


def evidence_panes(events: DataFrame, slide: str = "1 minute", coupon: str = COUPON) -> DataFrame:
    """Evidence counted by pane: ``pane`` (its start), ``mid``, ``kind``, ``value``, ``ct``; counts of parts of the events add up."""
    panes = _facts(events, coupon).groupBy(F.window("event_time", slide).alias("_pane"), "mid", "kind", "value")
    return panes.agg(F.count("*").alias("ct")).select(F.col("_pane")["start"].alias("pane"), "mid", "kind", "value", "ct")


def evidence_of_panes(alerts: DataFrame, panes: DataFrame, window: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """The evidence of alerts from :func:`evidence_panes` of their devices."""
    mine = panes.join(alerts.select("mid").distinct(), "mid", "left_semi")
    counted = mine.groupBy(F.window("pane", window, slide).alias("window"), "mid", "kind", "value").agg(F.sum("ct").alias("ct"))
    return with_window_bounds(counted).join(alerts.select(*_ALERT), _ALERT, "left_semi")


def alert_documents(alerts: DataFrame, evidence: DataFrame) -> DataFrame:
    """One nested document per alert: user set, item set, events with their counts.

    For the document sink.  The arrays hold distinct values only.
    """
    def values(kind: str):
        return F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("value"))))

    events = F.array_sort(F.collect_list(F.when(F.col("kind") == "event", F.struct("value", "ct"))))
    sets = evidence.groupBy("stt", "edt", "mid").agg(
        values("uid").alias("uids"), values("item").alias("itemIds"), events.alias("events")
    )
    return alerts.join(sets, ["stt", "edt", "mid"])


def throttled(alerts: DataFrame) -> DataFrame:
    """One alert per device and minute, under the document id ``mid + minute``.

    The alert with the latest ``ts`` (then window) wins, as an overwrite by id would leave it.
    """
    keyed = alerts.withColumn("doc_id", F.concat("mid", minute_bucket("ts").cast("string")))
    rest = [c for c in alerts.columns if c not in ("ts", "mid", "stt")]
    first = ["ts", "stt"] if "stt" in alerts.columns else ["ts"]
    newest = F.max(F.struct(*first, *rest, "mid"))
    return keyed.groupBy("doc_id").agg(newest.alias("alert")).select("doc_id", "alert.*")
