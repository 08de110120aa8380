"""Micro-batch writers whose memory is a store in the shared folder instead of the checkpoint's state.

Only the parts of the store that a batch touches are opened.  What is held for the batch's keys is found by a semi-join with them, for
which Spark broadcasts the batch's keys when they are few; the store itself is not shuffled then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import alerts, joins
from millrace.operators.latest import first_by_key
from millrace.operators.visits import TIE
from millrace.sinks.files import BatchWriter
from millrace.sinks.stores import PartedStore, bucket_of, origin_of


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equal in all the columns, null being equal to null."""
    return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in columns))


def _parts_of(batch: DataFrame, part: Column) -> list[str | None]:
    """The different parts of a batch: its days or buckets, a bounded number."""
    return [r[0] for r in batch.select(part.cast("string")).distinct().collect()]


# -- seen keys --------------------------------------------------------------

def first_seen_writer(
    store: PartedStore, write: BatchWriter, keys: tuple[str, ...] = ("mid",), day: str = "logDate", order: tuple[str, ...] = ("ts", TIE),
    most: int = 50,
) -> BatchWriter:
    """Pass on the first row of each key and day, however often the query is started anew.

    The store has a part per day, of which only the days of the batch's rows are opened.  Inside a batch the row
    that comes first by ``order`` counts.  Rows without a key, and those without a day, count as one key and one day.
    """
    names = [*keys, day]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        firsts = first_by_key(batch, names, [c for c in order if c in batch.columns]).persist()
        try:
            schema = T.StructType([T.StructField(c, batch.schema[c].dataType) for c in names])
            days = _parts_of(firsts, F.col(day))
            store.compact(spark, days, schema, batch_id, most)
            mine = firsts.select(*names)
            held = store.read(spark, days, schema, batch_id)
            known = held.join(mine, _same(held, mine, names), "left_semi")
            fresh = firsts.join(known, _same(firsts, known, names), "left_anti").persist()
            try:
                write(fresh, batch_id)
                store.append(fresh.select(*names), F.col(day), batch_id)
            finally:
                fresh.unpersist()
        finally:
            firsts.unpersist()

    return run


# -- orders and details that wait for each other ----------------------------

def sale_rows(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders and details as one stream: ``order_key`` and either ``placed`` or ``detail``."""
    left = orders.select(F.col("id").alias("order_key"), F.struct(*orders.columns).alias("placed"))
    right = details.select(F.col("order_id").alias("order_key"), F.struct(*details.columns).alias("detail"))
    return left.unionByName(right, allowMissingColumns=True)


def pending_sale_writer(
    store: PartedStore, write: BatchWriter, buckets: int = 256, keep: str | None = None, most: int = 50, salts: int = 4,
) -> BatchWriter:
    """Join orders with their details, however long one arrives after the other; takes :func:`sale_rows`.

    Orders stay in the store, for the details still to come; details go to it until their order is there.  Only the
    buckets of the batch's order ids are opened, and only rows with these ids are joined.  A part that is brought together drops
    the details that an earlier batch matched and, with ``keep`` (such as ``"90 days"``), orders and details that arrived
    longer ago.  A record that comes again word for word while the first one is held counts once; a detail that comes again after
    it was matched gives its pair again, so a sink keyed by ``order_detail_id`` holds it once.  An order id comes once: a second
    record of an order does not meet details that the first has already got.  Rows without an order id match nothing and are not kept.
    """

    def emptied(rows: DataFrame) -> DataFrame:
        if keep:
            rows = rows.where(F.col("arrived") >= F.current_timestamp() - F.expr(f"INTERVAL {keep}"))
        there = rows.where("placed IS NOT NULL").select("order_key")
        waiting = rows.where("placed IS NULL").join(there, "order_key", "left_anti")
        return rows.where("placed IS NOT NULL").unionByName(waiting)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.select("order_key", "placed", "detail").where("order_key IS NOT NULL").persist()
        schema = T.StructType([*new.schema.fields, T.StructField("arrived", T.TimestampType())])
        try:
            touched = _parts_of(new, bucket_of("order_key", buckets))
            store.compact(spark, touched, schema, batch_id, most, emptied)
            old = store.read(spark, touched, schema, batch_id).drop("arrived")
            old = old.join(new.select("order_key").distinct(), "order_key", "left_semi")
            # a row held already, or held twice, is one that is not new
            rows = old.withColumn("fresh", F.lit(False)).unionByName(new.withColumn("fresh", F.lit(True)))
            rows = rows.groupBy(*new.columns).agg(F.min("fresh").alias("fresh")).persist()
            try:
                kind = lambda name, when=None: rows.where(F.col(name).isNotNull() & (F.lit(True) if when is None else when)).select(f"{name}.*")
                pairs = joins.sale_details(kind("placed", F.col("fresh")), kind("detail"), salts=salts).unionByName(
                    joins.sale_details(kind("placed", ~F.col("fresh")), kind("detail", F.col("fresh")), salts=salts))
                write(pairs, batch_id)
                there = rows.where("placed IS NOT NULL").select("order_key").distinct()
                waiting = rows.where("placed IS NULL").join(there, "order_key", "left_anti")
                stays = rows.where("placed IS NOT NULL").unionByName(waiting).where("fresh").drop("fresh")
                store.append(stays.withColumn("arrived", F.current_timestamp()), bucket_of("order_key", buckets), batch_id)
            finally:
                rows.unpersist()
        finally:
            new.unpersist()

    return run


# -- panes of events --------------------------------------------------------

PANES = T.StructType([
    T.StructField("pane", T.TimestampType()), *(T.StructField(c, T.StringType()) for c in ("mid", "kind", "value")),
    T.StructField("ct", T.LongType()), T.StructField("source", T.StringType()),
])


def _span(time: Column) -> Column:
    """Part of a pane: its hour."""
    return F.date_format(time, "yyyy-MM-dd-HH")


def pane_writer(store: PartedStore, slide: str = "1 minute", **options) -> BatchWriter:
    """Keep what each batch of events adds to the evidence of its panes; a part is an hour of panes.

    Devices without an id and events without a time are evidence of no alert and are left out.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        panes = alerts.evidence_panes(batch, slide, **options).withColumn("source", F.lit(origin_of(batch.sparkSession, batch_id)))
        store.append(panes.select(*PANES.names), _span(F.col("pane")), batch_id)

    return run


def evidence_of(store: PartedStore, window: str = "5 minutes", slide: str = "1 minute") -> Callable[[DataFrame], DataFrame]:
    """Reader of the evidence of given alerts; opens the hours their windows lie in."""

    def read(found: DataFrame) -> DataFrame:
        spark = found.sparkSession
        starts, ends = (F.col(c).cast("timestamp") for c in ("stt", "edt"))
        hours = F.sequence(F.date_trunc("hour", starts), F.date_trunc("hour", ends), F.expr("INTERVAL 1 HOUR"))
        parts = _parts_of(found.select(F.explode(hours).alias("hour")), _span(F.col("hour")))
        return alerts.evidence_of_panes(found, store.read(spark, parts, PANES).distinct(), window, slide)

    return read
