"""The keyword and province statistics as SQL over views, batch or streaming.

The views need ``event_time``; on a stream it carries the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.functions import sql as sql_functions
from millrace.functions.codes import KEYWORD_SEARCH
from millrace.functions.moments import WALL_CLOCK
from millrace.operators.stats import WINDOW

_BOUNDS = f"""date_format(window.start, '{WALL_CLOCK}') AS stt, date_format(window.end, '{WALL_CLOCK}') AS edt"""


def keyword_stats(spark: SparkSession, pages: str, window: str = WINDOW, source: str = KEYWORD_SEARCH) -> DataFrame:
    """Word counts of the searches in the page view ``pages``."""
    sql_functions.register(spark)
    return spark.sql(f"""
        WITH searches AS (
            SELECT page.item AS fullword, ts, event_time FROM {pages}
            WHERE page.last_page_id = 'search' AND page.item_type = 'keyword' AND page.item IS NOT NULL),
        found AS (SELECT word, ts, event_time FROM searches, LATERAL words(fullword)),
        counted AS (
            SELECT window(event_time, '{window}') AS window, word, count(*) AS ct, max(ts) AS ts
            FROM found GROUP BY window(event_time, '{window}'), word)
        SELECT word AS keyword, ct, '{source}' AS source, {_BOUNDS}, ts FROM counted""")


def province_stats(spark: SparkSession, wide: str, window: str = WINDOW, amount: str = "split_total_amount") -> DataFrame:
    """Amount and distinct orders per province of the wide order view ``wide``."""
    keys = "province_id, province_name, province_area_code, province_iso_code, province_3166_2_code"
    return spark.sql(f"""
        WITH per_order AS (
            SELECT window(event_time, '{window}') AS window, {keys}, order_id,
                   sum(CAST({amount} AS DECIMAL(16,2))) AS amount, max(unix_millis(event_time)) AS ts
            FROM {wide} GROUP BY window(event_time, '{window}'), {keys}, order_id),
        counted AS (
            SELECT window, {keys}, sum(amount) AS order_amount, count(order_id) AS order_count, max(ts) AS ts
            FROM per_order GROUP BY window, {keys})
        SELECT {_BOUNDS}, {keys}, order_amount, order_count, ts FROM counted""")
