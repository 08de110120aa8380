"""Database sink for finished statistics rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame


def jdbc_options(url: str, table: str, driver: str | None = None, batch_size: int = 1000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), "isolationLevel": "NONE"}
    if driver:
        options["driver"] = driver
    return options


def insert(
    url: str,
    table: str,
    columns: Sequence[str],
    *,
    transient: Sequence[str] = (),
    driver: str | None = None,
    batch_size: int = 1000,
    extra: Mapping[str, str] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Insert rows in the table's column order, without the transient columns.

    The insert is at-least-once: keep a replacing key (window, group) on the table.
    """
    options = {**jdbc_options(url, table, driver, batch_size), **(extra or {})}

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*[c for c in columns if c not in transient])
        rows.write.format("jdbc").options(**options).mode("append").save()

    return write
