"""Bulk writes that report the items they could not take."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sinks.files import BatchWriter

NO_ID, TOO_LARGE = "no id", "too large"
# Fixed value: the usual limit of a document store's request, in bytes.
MOST_BYTES = 100 * 1024 * 1024


def reporting(
    write: BatchWriter, rejects: BatchWriter, key: str = "doc_id", most_bytes: int = MOST_BYTES,
    report: Callable[[int, dict[str, int]], None] | None = None,
) -> BatchWriter:
    """Write the documents that can be written, and one row for each that cannot: ``key``, ``reason``, ``bytes``, ``document``.

    A document without a key, or longer than ``most_bytes`` as JSON, is rejected; the others of its batch are written.  ``document`` is
    the JSON text, null where that is too large.  ``report`` is told the batch and the number of rows ``written`` and by reason.  Both
    writers replace what the same batch wrote before.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns])))
        marked = batch.withColumn("_bytes", size).withColumn(
            "_reason", F.when(F.col(f"`{key}`").isNull(), NO_ID).when(F.col("_bytes") > most_bytes, TOO_LARGE)).persist()
        try:
            write(marked.where("_reason IS NULL").drop("_bytes", "_reason"), batch_id)
            text = F.when(F.col("_bytes") <= most_bytes, F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns])))
            rejects(marked.where("_reason IS NOT NULL").select(
                F.col(f"`{key}`").alias(key), F.col("_reason").alias("reason"), F.col("_bytes").alias("bytes"), text.alias("document")), batch_id)
            if report:
                # one row a reason
                counts = {r["_reason"] or "written": r["count"] for r in marked.groupBy("_reason").count().collect()}
                report(batch_id, {"written": 0, **counts})
        finally:
            marked.unpersist()

    return run
