"""Rows that a job keeps beside its checkpoint, so that they outlive it.

A :class:`PartedStore` is cut into parts (a day, a bucket of keys, a span of panes).  Whoever reads it names the parts, and
no other folder is opened.  Each micro-batch writes its rows to folders of its own, named by query and batch, in overwrite
mode.  A batch that is run again reads the store without what it wrote the first time, and then writes the same again.
One query writes a store at a time; a new checkpoint is a new query and goes on with what the others left.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, ORIGIN = "part", "origin"
_BATCH = "batch"
# Part of the rows whose part is unknown.
NO_PART = "none"


def origin_of(spark: SparkSession, batch_id: int) -> str:
    """Name of a micro-batch: its query, which stays the same over restarts from one checkpoint, and its number."""
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId') or 'batch'}-{batch_id}"


def bucket_of(key: Column | str, buckets: int) -> Column:
    """Part of a key, as text."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")


class PartedStore:
    """A set of rows in ``path/part=P/origin=QUERY-BATCH``.

    Rows count as a set: a crash between the two steps of :meth:`compact` leaves copies of a row, never a loss.  A null part is
    the part ``none``.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def append(self, rows: DataFrame, part: Column, batch_id: int) -> None:
        """Add the rows of one micro-batch."""
        self._write(rows.withColumn(_BATCH, F.lit(origin_of(rows.sparkSession, batch_id))), part, origin_of(rows.sparkSession, batch_id))

    def read(self, spark: SparkSession, parts: Iterable[str | None], schema: T.StructType, batch_id: int | None = None) -> DataFrame:
        """Rows of the named parts, without those that this batch wrote when it was run before."""
        rows = self._open(spark, self._held(spark, parts), schema)
        if batch_id is not None:
            rows = rows.where(F.col(_BATCH) != origin_of(spark, batch_id))
        return rows.select(*schema.names)

    def compact(
        self, spark: SparkSession, parts: Iterable[str | None], schema: T.StructType, batch_id: int, most: int = 50,
        keep: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Bring each named part with more than ``most`` folders into one, with the rows that ``keep`` leaves.

        Call it before a batch reads: what the batch wrote in an earlier run is neither seen nor moved, so nothing is
        dropped because of a match that the batch is about to make again.
        """
        fs, path = self._fs(spark)
        own = origin_of(spark, batch_id)
        full: dict[str, list[str]] = {}
        for folder in self._held(spark, parts):
            found = [str(s.getPath().getName()) for s in fs.listStatus(path(folder))]
            found = [f for f in found if f.startswith(f"{ORIGIN}=") and f != f"{ORIGIN}={own}"]
            if len(found) > most:
                full[folder] = found
        if not full:
            return
        rows = self._open(spark, [f"{p}/{f}" for p, found in full.items() for f in found], schema).distinct()
        rows = keep(rows) if keep else rows
        # A name of its own: a second attempt must not replace what the first has already moved.
        self._write(rows, F.col(PART), f"merged-{uuid.uuid4().hex}")
        for part, found in full.items():
            for folder in found:
                fs.delete(path(f"{part}/{folder}"), True)

    def expire(self, spark: SparkSession, before: str) -> None:
        """Remove the parts whose name is less than ``before``; for parts named by time."""
        fs, path = self._fs(spark)
        for name in self._parts(spark):
            if name < before:
                fs.delete(path(f"{self.path}/{PART}={name}"), True)

    def _write(self, rows: DataFrame, part: Column, origin: str) -> None:
        placed = rows.withColumns({PART: F.coalesce(part.cast("string"), F.lit(NO_PART)), ORIGIN: F.lit(origin)})
        # A part's rows go to few tasks; adaptive execution splits one that holds most of them.
        placed.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            PART, ORIGIN).parquet(self.path)

    def _open(self, spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
        full = T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in (_BATCH, PART, ORIGIN))])
        if not folders:
            return spark.createDataFrame([], full)
        return spark.read.schema(full).option("basePath", self.path).parquet(*folders).drop(ORIGIN)

    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _parts(self, spark: SparkSession) -> list[str]:
        fs, path = self._fs(spark)
        if not fs.exists(path(self.path)):
            return []
        names = (str(s.getPath().getName()).partition("=") for s in fs.listStatus(path(self.path)))
        return sorted(value for key, _, value in names if key == PART)

    def _held(self, spark: SparkSession, parts: Iterable[str | None]) -> list[str]:
        wanted = {NO_PART if p is None else str(p) for p in parts}
        return [f"{self.path}/{PART}={p}" for p in self._parts(spark) if p in wanted]
