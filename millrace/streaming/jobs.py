"""The shop's streaming jobs: lines in, frames out.

A job takes frames with a ``value`` column (see :mod:`millrace.sources.feeds`),
streaming or batch, and returns the frame(s) to write.  :func:`start` attaches a
sink, a trigger and a checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.functions.moments import day_of, from_millis
from millrace.operators import alerts, changes, joins, logs, orders, stats
from millrace.operators.logs import is_entry
from millrace.operators.visits import with_log_time
from millrace.sinks.files import BatchWriter, UpsertTable
from millrace.sinks.kafka import MESSAGE_ID, routed_messages
from millrace.sinks.stores import PartedStore
from millrace.sources.feeds import records
from millrace.streaming import joins as stream_joins
from millrace.streaming import kept, keyed

# Micro-batch intervals of the start-up, order, alert and user jobs, and of the sale job.
EVERY, EVERY_SALE = "5 seconds", "3 seconds"


def start(
    df: DataFrame,
    writer: BatchWriter | None = None,
    *,
    checkpoint: str,
    every: str | None = EVERY,
    mode: str = "append",
    sink: str = "console",
    options: Mapping[str, str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query.  ``every=None`` processes what is there and stops.

    The checkpoint is required: offsets and state recover from it.
    """
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        query = query.queryName(name)
    query = query.trigger(processingTime=every) if every else query.trigger(availableNow=True)
    query = query.foreachBatch(writer) if writer else query.format(sink).options(**(options or {}))
    return query.start()


# -- logs -------------------------------------------------------------------

def base_log(lines: DataFrame) -> DataFrame:
    """Log records with repaired ``is_new``, for :func:`split_log_writer`.

    One frame, so that the lines are parsed and the device flags kept once for the
    three kinds of records.
    """
    return keyed.repair_is_new(logs.parse_logs(lines))


def dirty_log(lines: DataFrame) -> DataFrame:
    """The lines that are no JSON objects."""
    return logs.parse_dirty(lines)


def split_log_writer(writers: Mapping[str, BatchWriter]) -> BatchWriter:
    """Write the three kinds of log records of one pass over the stream."""
    split = {"dwd_start_log": logs.start_logs, "dwd_page_log": logs.page_logs, "dwd_display_log": logs.display_logs}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, writer in writers.items():
                writer(split[name](batch), batch_id)
        finally:
            batch.unpersist()

    return write


def log_message(pages: DataFrame) -> DataFrame:
    """Flat page records back to log lines, as the next job reads them."""
    common = F.struct("mid", "vc", "ch", "ar", "is_new").alias("common")
    rest = [c for c in ("log_id", "page", "start", "displays", "ts") if c in pages.columns]
    return pages.select(F.to_json(F.struct(common, *rest)).alias("value"))


def unique_visit(page_lines: DataFrame) -> DataFrame:
    """First visits by the checkpoint's state, as they arrive; :func:`unique_visit_writer` goes by time and remembers longer."""
    return log_message(keyed.unique_visits(logs.page_logs(logs.parse_logs(page_lines))))


def entries(page_lines: DataFrame) -> DataFrame:
    """Entry pages with their day, for :func:`unique_visit_writer`."""
    pages = logs.page_logs(logs.parse_logs(page_lines)).where(is_entry())
    return pages.withColumn("visit_day", day_of(from_millis("ts")))


def unique_visit_writer(store: PartedStore, write: BatchWriter, **options) -> BatchWriter:
    """Write the first visit of each device and day as a line.  Of a micro-batch's entry pages the earliest by time counts."""
    send = lambda rows, batch_id: write(log_message(rows.drop("visit_day")), batch_id)
    return kept.first_seen_writer(store, send, ("mid",), "visit_day", **options)


def user_jump(
    page_lines: DataFrame, within: timedelta = timedelta(seconds=10), delay: str = "10 seconds", shards: int = 512
) -> DataFrame:
    pages = logs.page_logs(logs.parse_logs(page_lines))
    return log_message(keyed.user_jumps(pages, within, delay, shards=shards))


def visitor_stats(
    page_lines: DataFrame,
    visit_lines: DataFrame,
    jump_lines: DataFrame,
    window: str = stats.WINDOW,
    delay: str = "10 seconds",
) -> DataFrame:
    """Three topics to visitor statistics.

    Each source has its own watermark; bounces, which appear late, hold the
    windows open until they are in.
    """
    pages, visits, jumps = (logs.page_logs(logs.parse_logs(x)) for x in (page_lines, visit_lines, jump_lines))
    rows = stats.visitor_stats(pages, visits, jumps, window, delay)
    return rows.select(*schemas.VISITOR_STATS_COLUMNS)


def keyword_stats(page_lines: DataFrame, window: str = stats.WINDOW, delay: str = "2 seconds", words=()) -> DataFrame:
    pages = logs.page_logs(logs.parse_logs(page_lines))
    return stats.keyword_stats(pages, window, delay, words=words).select(*schemas.KEYWORD_STATS_COLUMNS)


# -- changes ----------------------------------------------------------------

def change_messages(connect_records: DataFrame) -> DataFrame:
    """Connector records (``topic``, ``value``) to change lines."""
    return changes.decode_connect(connect_records).select(F.to_json(F.struct("*")).alias("value"))


def forwarded(change_lines: DataFrame) -> DataFrame:
    """Order, detail and user changes as (topic, value)."""
    return changes.route_static(changes.parse_changes(change_lines)).select("topic", "value")


def base_db_writer(
    read_routes: Callable[[], DataFrame], write_facts: BatchWriter, dim_tables: Callable[[str, str, list[str]], UpsertTable],
    order: str | None = None, position: Sequence[str] = (),
) -> BatchWriter:
    """Route change lines by the routing table as it stands at each micro-batch.

    ``read_routes`` reads the routing table anew; facts go to ``write_facts`` as
    (topic, value), dimension changes to ``dim_tables(sink table, key, columns)``, a table with the
    column ``image``: a change sets the columns its route lists.  Every configured dimension is created, also
    before its first row.  ``order`` names the column of the source position (a topic's ``offset``), by which a
    batch's changes are ordered; without it their place in the input files counts.  Offsets order a key's changes only if the
    topic is keyed, so that they share a partition; from an unkeyed topic give a column that rises with the source's time.  ``position`` names the columns that
    tell a source record from all others (``topic``, ``partition``, ``offset``): the facts then carry a ``message_id`` made of them,
    by which a reader (:func:`millrace.sinks.kafka.once`) leaves out what a batch sent twice.
    """
    named = [MESSAGE_ID] if position else []

    def write(batch: DataFrame, batch_id: int) -> None:
        routes = read_routes()
        # offsets rise within a partition: they order the changes of a topic that is keyed by row
        placed = batch.withColumn("seq", F.col(order).cast("long") if order else F.monotonically_increasing_id())
        if position:
            placed = placed.withColumn(MESSAGE_ID, F.concat_ws("/", *[F.col(c).cast("string") for c in position]))
        rows = changes.with_after_image(changes.parse_changes(placed, keep=["seq", *named])).withColumn("batch", F.lit(batch_id).cast("long"))
        routed = changes.route_by_config(rows, routes).persist()
        try:
            write_facts(routed_messages(changes.facts(routed)), batch_id)
            # One writer per configured dimension: a handful of routing rows.
            targets = routes.where(F.col("sinkType") == changes.DIM_SINK).select(
                "sinkTable", F.coalesce("sinkPk", F.lit("id")).alias("key"), "sinkColumns"
            ).distinct().collect()
            for name in sorted({t.sinkTable for t in targets}):
                mine = [t for t in targets if t.sinkTable == name]
                keys = {t.key for t in mine}
                if len(keys) > 1:
                    raise ValueError(f"routes give {name} different keys: {sorted(keys)}")
                key, = keys
                columns = sorted({c for t in mine for c in t.sinkColumns.split(",")} | {key})
                table = dim_tables(name, key, columns)
                table.declare(batch.sparkSession)
                dim_rows = changes.dims(routed).where(F.col("sinkTable") == name).select(
                    F.try_element_at("data", F.lit(key)).alias(key), F.col("data").alias("image"), "batch", "seq")
                table.write(dim_rows.where(F.col(key).isNotNull()), batch_id)
        finally:
            routed.unpersist()

    return write


# -- orders -----------------------------------------------------------------

def order_wide(
    order_lines: DataFrame,
    detail_lines: DataFrame,
    dims: Mapping[str, DataFrame] | None = None,
    as_of: str | None = None,
    how: str = "inner",
    delay: str = "0 seconds",
) -> DataFrame:
    """Details with their orders, and with the dimensions when given.

    A frame of dimension files keeps the file list it started with.  Where dimensions
    change while the query runs, leave ``dims`` out and write through
    :func:`enrich_writer`.
    """
    wide = orders.order_wide(
        records(order_lines, "dwd_order_info"), records(detail_lines, "dwd_order_detail"), delay=delay
    )
    if dims is None:
        return wide
    return orders.order_wide_table(joins.enrich(wide, dims, joins.order_dims(as_of, how)))


def enrich_writer(
    read_dims: Callable[[], Mapping[str, DataFrame]],
    specs: Callable[[], Sequence[joins.DimSpec]],
    write: BatchWriter,
    columns: Sequence[str] | None = None,
) -> BatchWriter:
    """Join each micro-batch with the dimensions as they stand, then write it.

    ``specs`` is asked anew as well, so that ages follow the calendar.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = joins.enrich(batch, read_dims(), specs())
        write(rows.select(*columns) if columns else rows, batch_id)

    return run


def payment_wide(payment_lines: DataFrame, wide: DataFrame, delay: str = "0 seconds") -> DataFrame:
    return orders.payment_wide_table(
        orders.payment_wide(records(payment_lines, "dwd_payment_info"), wide, delay=delay)
    )


def province_stats(wide: DataFrame, window: str = stats.WINDOW, delay: str = "0 seconds", **options) -> DataFrame:
    return stats.province_stats(wide, window, delay, **options).select(*schemas.PROVINCE_STATS_COLUMNS)


def product_stats(
    page_lines: DataFrame,
    favor_lines: DataFrame,
    cart_lines: DataFrame,
    wide: DataFrame,
    paid: DataFrame,
    refund_lines: DataFrame,
    comment_lines: DataFrame,
    dims: Mapping[str, DataFrame] | None = None,
    window: str = stats.WINDOW,
    delay: str = "1 second",
    how: str = "inner",
) -> DataFrame:
    """Seven sources to product statistics; dimensions are joined to the finished rows.

    Leave ``dims`` out to join them in :func:`enrich_writer`.
    """
    pages = logs.page_logs(logs.parse_logs(page_lines))
    rows = stats.product_stats(
        [
            stats.page_rows(pages, delay),
            stats.favor_rows(records(favor_lines, "dwd_favor_info"), delay),
            stats.cart_rows(records(cart_lines, "dwd_cart_info"), delay),
            stats.order_rows(wide, delay),
            stats.payment_rows(paid, delay),
            stats.refund_rows(records(refund_lines, "dwd_order_refund_info"), delay),
            stats.comment_rows(records(comment_lines, "dwd_comment_info"), delay),
        ],
        window,
    )
    if dims is None:
        return rows
    return joins.enrich(rows, dims, joins.product_dims(how)).select(*schemas.PRODUCT_STATS_COLUMNS)


# -- micro-batch jobs -------------------------------------------------------

def dau(startup_lines: DataFrame, delay: str = keyed.DAY) -> DataFrame:
    """First start-ups by the checkpoint's state; :func:`dau_writer` remembers beyond the checkpoint."""
    return keyed.daily_actives(records(startup_lines, "startup_log"), delay)


def startups(startup_lines: DataFrame) -> DataFrame:
    """Start-up records with their day and hour, for :func:`dau_writer`."""
    return with_log_time(records(startup_lines, "startup_log"))


def dau_writer(store: PartedStore, write: BatchWriter, **options) -> BatchWriter:
    """Write the first start-up of each device and day, also when the query starts from a new checkpoint."""
    return kept.first_seen_writer(store, write, ("mid",), "logDate", **options)


def gmv(order_lines: DataFrame) -> DataFrame:
    return orders.with_create_parts(records(order_lines, "shop_order"))


def coupon_alert(event_lines: DataFrame, window: str = "5 minutes", slide: str = "1 minute", delay: str = "10 seconds", **options) -> DataFrame:
    return alerts.coupon_alerts(with_log_time(records(event_lines, "event_log")), window, slide, delay=delay, **options)


def event_rows(event_lines: DataFrame) -> DataFrame:
    """Event records, for :func:`kept.pane_writer`."""
    return records(event_lines, "event_log")


def alert_writer(
    table: UpsertTable, read_events: Callable[[], DataFrame] | None = None, *, panes: PartedStore | None = None,
    window: str = "5 minutes", slide: str = "1 minute", **options,
) -> BatchWriter:
    """Write alerts into a table keyed by ``doc_id`` (device and minute); the last one of an id stays.

    With ``panes``, a store that :func:`kept.pane_writer` fills, each alert's users, items and events are written with it; only
    the hours of the alerts' windows are opened.  With ``read_events``, a reader of all stored events, they are counted from those.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        found = batch.persist()
        try:
            if panes is not None:
                found = alerts.alert_documents(batch, kept.evidence_of(panes, window, slide)(batch))
            elif read_events is not None:
                found = alerts.alert_documents(batch, alerts.alert_evidence(batch, read_events(), window, slide, **options))
            table.write(alerts.throttled(found), batch_id)
        finally:
            batch.unpersist()

    return write


def sale_detail(
    order_lines: DataFrame, detail_lines: DataFrame, arrival: str = "timestamp", **bounds
) -> DataFrame:
    """Orders with details by arrival time, up to ``wait`` apart; users are joined in :func:`sale_user_writer`.

    :func:`sale_rows` with :func:`kept.pending_sale_writer` has no such limit.
    """
    placed = orders.with_create_parts(records(order_lines, "shop_order", keep=[arrival]))
    return stream_joins.sale_details(
        placed, records(detail_lines, "shop_order_detail", keep=[arrival]),
        order_time=arrival, detail_time=arrival, **bounds,
    )


def sale_rows(order_lines: DataFrame, detail_lines: DataFrame) -> DataFrame:
    """Orders and details in one stream, for :func:`kept.pending_sale_writer`."""
    return kept.sale_rows(orders.with_create_parts(records(order_lines, "shop_order")), records(detail_lines, "shop_order_detail"))


def sale_user_writer(read_users: Callable[[], DataFrame], as_of: Callable[[], str], write: BatchWriter) -> BatchWriter:
    """Join each micro-batch with the users as they stand, then write it."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = joins.with_sale_user(batch, read_users(), as_of())
        write(rows.select(*schemas.SALE_DETAIL_COLUMNS), batch_id)

    return run


def user_info(user_lines: DataFrame) -> DataFrame:
    """User records for an upsert table keyed by id."""
    return records(user_lines, "shop_user")
