"""File sinks.

A micro-batch is written to a folder of its own, ``batch_id=N``, in overwrite
mode: a batch replayed after a failure replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.moments import day_of
from millrace.operators.latest import latest_by_column, latest_by_key

BatchWriter = Callable[[DataFrame, int], None]


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def append(path: str, columns: Sequence[str] | None = None, partition_by: Sequence[str] = ()) -> BatchWriter:
    """Append rows, in a fixed column order, optionally partitioned."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns) if columns else batch
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(_batch_folder(path, batch_id))

    return write


def by_topic(path: str) -> BatchWriter:
    """Routed messages, one folder per topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("topic").json(_batch_folder(path, batch_id))

    return write


def dated(path: str, time: str, columns: Sequence[str] | None = None) -> BatchWriter:
    """One folder per day ``dt`` of a time column (dated index names)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("dt", day_of(time))
        append(path, [*columns, "dt"] if columns else None, ["dt"])(rows, batch_id)

    return write


def archive(path: str) -> BatchWriter:
    """Raw lines as they came, one folder per arrival day."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("value", day_of(F.current_timestamp()).alias("dt"))
        rows.write.mode("overwrite").partitionBy("dt").text(_batch_folder(path, batch_id))

    return write


def to_many(*writers: BatchWriter) -> BatchWriter:
    """Several sinks for one frame, which is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


class UpsertTable:
    """A table keyed like an upsert store: change rows plus a snapshot now and then.

    ``changes/batch_id=N`` holds what each micro-batch wrote; ``snapshots/upto=N`` holds the state up to
    batch N.  A read opens the newest finished snapshot and the finished batches after it, so its cost does not
    grow with the table's history: every ``compact_every`` batches the writer makes a snapshot and removes
    what it holds, except what a reader may just be opening (the last snapshot and its batches).

    ``image`` names a map column with the columns a change carries: then a change sets those columns and
    leaves the others as they are.  ``columns`` is the declared schema of such a table; :meth:`read` returns it,
    with nulls for what no change has set, and columns added to it later appear at once.
    """

    def __init__(
        self, path: str, keys: Sequence[str], order: Sequence[str], deleted: str | None = None, *,
        image: str | None = None, columns: Sequence[str] = (), compact_every: int = 50,
    ):
        self.path, self.keys, self.order, self.deleted = path.rstrip("/"), list(keys), list(order), deleted
        self.image, self.columns, self.compact_every = image, list(columns), compact_every

    def write(self, batch: DataFrame, batch_id: int) -> None:
        # Within a batch only the last row of a key, or the last value of its columns, can survive.
        self._latest(batch).write.mode("overwrite").parquet(f"{self.path}/changes/batch_id={batch_id}")
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            self.compact(batch.sparkSession, batch_id)
            self._tidy(batch.sparkSession)

    def create(self, spark: SparkSession, schema: T.StructType) -> None:
        """Create the empty table unless it is there."""
        if not self._finished(spark, "changes", "batch_id") and not self._finished(spark, "snapshots", "upto"):
            self.write(spark.createDataFrame([], schema), -1)

    def declare(self, spark: SparkSession) -> None:
        """Create an empty table of changes by column, as :meth:`write` takes them, unless it is there."""
        fields = [*self.keys, f"{self.image}:map<string,string>", *[f"{c}:long" for c in self.order]]
        self.create(spark, T._parse_datatype_string("struct<" + ",".join(f if ":" in f else f"{f}:string" for f in fields) + ">"))

    def read(self, spark: SparkSession) -> DataFrame:
        """State of every key that is not deleted."""
        rows = self._merged(spark)
        if self.deleted:
            rows = rows.where(~F.coalesce(F.col(self.deleted), F.lit(False)))
        if self.image is None or not self.columns:
            return rows
        rest = [c for c in self.columns if c not in self.keys]
        return rows.select(*self.keys, *[F.try_element_at(self.image, F.lit(c)).alias(c) for c in rest], *self.order)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Write the snapshot of all batches up to ``upto``.

        Deletion marks stay, so that an older change arriving later stays older.
        """
        self._merged(spark, upto).write.mode("overwrite").parquet(f"{self.path}/snapshots/upto={upto}")

    def _latest(self, rows: DataFrame) -> DataFrame:
        if self.image is None:
            return latest_by_key(rows, self.keys, self.order)
        rest = [c for c in rows.columns if c not in (*self.keys, *self.order, self.image)]
        images = latest_by_column(rows, self.keys, self.image, self.order)
        last = latest_by_key(rows, self.keys, self.order).select(*self.keys, *self.order, *rest)
        return last.join(images, self.keys, "left").select(*rows.columns)

    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path

    def _finished(self, spark: SparkSession, part: str, name: str) -> list[int]:
        """Numbers of the folders whose writer has finished, in order; only names are listed, no files."""
        fs, path = self._fs(spark)
        folder = path(f"{self.path}/{part}")
        if not fs.exists(folder):
            return []
        found = (str(s.getPath().getName()).partition("=") for s in fs.listStatus(folder))
        numbers = sorted(int(n) for key, _, n in found if key == name)
        return [n for n in numbers if fs.exists(path(f"{self.path}/{part}/{name}={n}/_SUCCESS"))]

    def _tidy(self, spark: SparkSession) -> None:
        """Remove batches and snapshots that the last two snapshots make superfluous."""
        snapshots = self._finished(spark, "snapshots", "upto")
        if len(snapshots) < 2:
            return
        fs, path = self._fs(spark)
        for part, name, old in (
            ("snapshots", "upto", snapshots[:-2]),
            ("changes", "batch_id", [n for n in self._finished(spark, "changes", "batch_id") if n <= snapshots[-2]]),
        ):
            for n in old:
                fs.delete(path(f"{self.path}/{part}/{name}={n}"), True)

    def _merged(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        snapshots = [n for n in self._finished(spark, "snapshots", "upto") if upto is None or n < upto]
        base = snapshots[-1] if snapshots else None
        batches = [
            n for n in self._finished(spark, "changes", "batch_id") if (base is None or n > base) and (upto is None or n <= upto)]
        folders = [f"{self.path}/changes/batch_id={n}" for n in batches]
        # Batches may differ in their columns; only the few opened here are asked for them.
        changes = spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None
        if base is None:
            if changes is None:
                raise ValueError(f"no table at {self.path}")
            return self._latest(changes)
        snapshot = spark.read.parquet(f"{self.path}/snapshots/upto={base}")
        if changes is None:
            return snapshot
        # Only keys changed since the snapshot are merged.  The others pass through,
        # without a shuffle as long as the changed keys are few enough to broadcast.
        changed = changes.select(*self.keys).distinct()
        touched = snapshot.join(changed, self.keys, "left_semi")
        merged = self._latest(changes.unionByName(touched, allowMissingColumns=True))
        untouched = snapshot.join(changed, self.keys, "left_anti")
        return untouched.unionByName(merged, allowMissingColumns=True)
