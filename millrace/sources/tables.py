"""Reads from database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.text import camel_case


def jdbc_options(url: str, query: str, driver: str | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    options = {"url": url, "query": query, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    return options


def read_query(
    spark: SparkSession, url: str, query: str, *, driver: str | None = None, camel: bool = False
) -> DataFrame:
    """Rows of a SQL query, optionally with ``lower_underscore`` names in camel case."""
    rows = spark.read.format("jdbc").options(**jdbc_options(url, query, driver)).load()
    return camel_columns(rows) if camel else rows


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel_case(c) for c in df.columns])
