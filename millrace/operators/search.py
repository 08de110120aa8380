"""Search: exact-term filter with word match, paging, top buckets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import match_score


def search(docs: DataFrame, terms: Mapping[str, object], field: str, query: str) -> DataFrame:
    """Documents equal on all ``terms`` whose ``field`` shares a word with ``query``.

    ``score`` counts the matching words of the text.
    """
    rows = docs
    for name, value in terms.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows.withColumn("score", match_score(field, query).cast("long")).where(F.col("score") > 0)


def hit_total(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count("*").alias("total"))


def page_of(hits: DataFrame, key: str, size: int, start: int = 0) -> DataFrame:
    """``size`` hits from position ``start``, best score first, then by ``key``."""
    return hits.orderBy(F.desc("score"), F.asc(key)).offset(start).limit(size)


def top_terms(rows: DataFrame, field: str, size: int = 10, **metrics) -> DataFrame:
    """The ``size`` most frequent values of ``field`` with metric aggregates per value."""
    buckets = rows.groupBy(field).agg(
        F.count("*").alias("doc_count"), *[c.alias(n) for n, c in metrics.items()]
    )
    return buckets.orderBy(F.desc("doc_count"), F.asc(field)).limit(size)
