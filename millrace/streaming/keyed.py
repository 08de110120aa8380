"""Streaming operators that keep state per key."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.moments import from_millis
from millrace.operators.logs import is_entry
from millrace.operators.visits import TIE, look_ahead, with_log_time

DAY = "1 day"


def first_seen(df: DataFrame, keys: list[str], delay: str, salts: int = 8) -> DataFrame:
    """One row per key, the first to arrive, over a stream with ``event_time``.

    Two steps: first one row per (key, salt), then one per key.  The rows of a busy
    key are spread over ``salts`` tasks and only one per task goes on.  Which row of a
    key comes first inside one micro-batch is left open.
    """
    rows = df.withWatermark("event_time", delay)
    if salts > 1:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
        rows = rows.withColumn("_salt", salt).dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return rows.dropDuplicatesWithinWatermark(keys)


def unique_visits(pages: DataFrame, delay: str = DAY, salts: int = 8) -> DataFrame:
    """The first entry page of each device on each day, as it arrives.

    State is kept for ``delay`` behind the newest event; less than a day would
    let the same device through twice on one day.
    """
    entries = pages.where(is_entry()).withColumn("event_time", from_millis("ts"))
    entries = entries.withColumn("visit_day", F.to_date("event_time"))
    return first_seen(entries, ["mid", "visit_day"], delay, salts).drop("event_time", "visit_day")


def daily_actives(logs: DataFrame, delay: str = DAY, salts: int = 8) -> DataFrame:
    """The first start-up log of each device on each day, across all batches."""
    dated = with_log_time(logs).withColumn("event_time", from_millis("ts"))
    return first_seen(dated, ["mid", "logDate"], delay, salts).drop("event_time")


# -- bounces ----------------------------------------------------------------

def user_jumps(
    pages: DataFrame,
    within: timedelta = timedelta(seconds=10),
    delay: str = "10 seconds",
    tie: str = TIE,
    shards: int = 512,
) -> DataFrame:
    """Entry pages left without a further page, once the watermark proves it.

    Devices are dealt to ``shards`` groups, each cut into time cells, and a group is
    worked on as a whole: one call decides many devices.  Its state is the pages not
    yet decided, and goes when the watermark has passed the cell; neither a busy
    device nor the number of devices ever seen makes it grow.  Choose a few shards
    per core, and keep their number over the life of a checkpoint.  Pages still
    inside ``within`` of the watermark when a bounded run ends are not decided.
    """
    reach = within // timedelta(milliseconds=1)
    tie_type = pages.schema[tie].dataType.simpleString()
    record = F.when(is_entry(), F.to_json(F.struct(*pages.columns)))
    rows = (
        look_ahead(pages.withColumn("_record", record), F.col("ts"), within)
        .withColumn("event_time", from_millis("ts"))
        .withWatermark("event_time", delay)
        .select(
            F.pmod(F.xxhash64("mid"), F.lit(shards)).alias("shard"), "_cell", "event_time", "mid", "ts",
            F.col(tie).alias("tie"), is_entry().alias("entry"), F.col("_own").alias("own"),
            F.when(F.col("_own"), F.col("_record")).alias("record"),
        )
    )
    columns = ["mid", "ts", "tie", "entry", "own", "record"]
    buffer = (
        f"mid array<string>, ts array<bigint>, tie array<{tie_type}>, entry array<boolean>, own array<boolean>, "
        "record array<string>"
    )

    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [b[columns] for b in batches]
        if state.exists:
            held: Any = state.get
            parts.insert(0, pd.DataFrame(dict(zip(columns, map(list, held)))))
        if not parts:
            return
        line = pd.concat(parts, ignore_index=True).sort_values(["mid", "ts", "tie"], kind="stable", ignore_index=True)
        now = state.getCurrentWatermarkMs()
        same_device = line["mid"].eq(line["mid"].shift(-1))
        ts, following = line["ts"], line["ts"].shift(-1).where(same_device)
        decided = (following <= now) | (ts + reach <= now)
        next_entry = line["entry"].shift(-1).eq(True) & same_device
        bounced = following.isna() | (following - ts >= reach) | next_entry
        hits = line[decided & bounced & line["entry"].astype(bool) & line["own"].astype(bool)]
        rest = line[~decided]
        if rest.empty:
            state.remove()
        else:
            state.update(tuple(rest[c].tolist() for c in columns))
            state.setTimeoutTimestamp(max(now + 1, int(rest["ts"].min()) + reach))
        if not hits.empty:
            yield hits[["record"]]

    found = rows.groupBy("shard", "_cell").applyInPandasWithState(
        decide, "record string", buffer, "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(F.inline(F.array(F.from_json("record", pages.schema))))


# -- new visitors -----------------------------------------------------------

def repair_is_new(logs: DataFrame, tie: str = TIE, shards: int = 256) -> DataFrame:
    """Of a device's records claiming ``is_new = 1`` only the first keeps the claim.

    Only claims go through state; all other records, and claims without a device, pass by it as they are.
    Before the shuffle each Arrow batch settles all but its earliest claim per
    device; only that one is sent to the device's state.  The settled ones are spread
    over ``shards`` keys, so a busy device does not fill one task.  The state is
    one flag per device and is never dropped.
    """
    claim = F.coalesce((F.col("is_new") == "1") & F.col("mid").isNotNull(), F.lit(False))
    claims, others = logs.where(claim), logs.where(~claim)
    order = ["ts", "tie"]
    record = F.to_json(F.struct(*logs.columns), {"ignoreNullFields": "true"})
    rows = claims.select("mid", "ts", F.col(tie).alias("tie"), record.alias("record"))

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first = batch.index.isin(batch.sort_values(order, kind="stable").drop_duplicates("mid").index)
            yield batch.assign(candidate=first, repaired=~first)

    flags = [T.StructField(name, T.BooleanType()) for name in ("candidate", "repaired")]
    settled = rows.mapInPandas(settle, T.StructType([*rows.schema.fields, *flags]))
    keyed = settled.withColumns({
        "device": F.when(F.col("candidate"), F.col("mid")),
        "shard": F.when(F.col("candidate"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("record"), F.lit(shards))).cast("int"),
    })

    def flag(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[1] >= 0:
            for batch in batches:
                yield batch[["record", "repaired"]]
            return
        parts = list(batches)
        line = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        if len(line) > 1:
            line = line.sort_values(order, kind="stable")
        first = not state.exists
        if first:
            state.update((True,))
        repaired = [not (first and i == 0) for i in range(len(line))]
        yield pd.DataFrame({"record": line["record"].to_numpy(), "repaired": repaired})

    done = keyed.groupBy("device", "shard").applyInPandasWithState(
        flag, "record string, repaired boolean", "seen boolean", "append", GroupStateTimeout.NoTimeout
    )
    out = done.select("repaired", F.inline(F.array(F.from_json("record", logs.schema))))
    out = out.withColumn("is_new", F.when(F.col("repaired"), "0").otherwise(F.col("is_new"))).select(*logs.columns)
    return others.unionByName(out)
