"""The same functions for SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.functions.text import WORD


def register(spark: SparkSession) -> None:
    """Create the temporary SQL functions ``word_list(text)`` and ``words(text)``.

    ``words`` is a table function: ``SELECT word FROM t, LATERAL words(t.text)``.
    Both are SQL bodies, so they are planned as built-in expressions.
    """
    pattern = WORD.replace("\\", "\\\\")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION word_list(text STRING) RETURNS ARRAY<STRING>
        RETURN regexp_extract_all(lower(text), '{pattern}', 0)""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION words(text STRING) RETURNS TABLE (word STRING)
        RETURN SELECT explode(regexp_extract_all(lower(text), '{pattern}', 0))""")
