"""Session settings the operators rely on, and the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job wants, whatever the data size: AQE coalesces shuffle
# partitions and splits skewed join partitions.  No operator forces a broadcast:
# a side is broadcast when its files are below the first threshold, or when its
# size measured after a shuffle is below the second.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state on local disk with a changelog in the checkpoint: it may outgrow
    # the heap, and a lost executor restores it from there.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session with :data:`SETTINGS`; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for stream checkpoints.

    A cluster names it in ``spark.checkpoint.dir``.  ``fallback`` is used only
    when that is unset (tests); a machine-local folder would lose the state with
    the machine, so there is no silent default.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return root.rstrip("/")
