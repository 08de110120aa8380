"""First and latest record per key.

``row_number() = 1`` lets Spark keep one candidate per key in every input
partition before the shuffle (WindowGroupLimit), so a key that holds a large
share of the rows still reaches its reducer as a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str | Column], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def first_by_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The earliest record of each key; end ``order`` with a tiebreak column."""
    return _one_per_key(df, keys, [F.col(c).asc() for c in order])


def latest_by_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The last record of each key (what an upsert store holds)."""
    return _one_per_key(df, keys, [F.col(c).desc() for c in order])


def latest_by_column(df: DataFrame, keys: Sequence[str], image: str, order: Sequence[str]) -> DataFrame:
    """Per key the latest value of every column that some row's map ``image`` carries, as such a map.

    One row a carried column, so it is the columns, few per key, that are gathered again, never the rows.
    """
    values = df.select(*keys, *order, F.explode(image).alias("_name", "_value"))
    last = latest_by_key(values, [*keys, "_name"], order)
    return last.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_name", "_value"))).alias(image))
