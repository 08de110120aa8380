"""Query registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.inputs import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its equivalent SQL."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables(spark, folder)))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name], SQL[name] = run, sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Money as double and times as text, so that results compare across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)
