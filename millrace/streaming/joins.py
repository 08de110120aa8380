"""Two-stream joins with bounded state."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import joins


def full_outer_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    wait: timedelta,
    delay: str,
) -> DataFrame:
    """Full outer join of two streams; a row unmatched after ``wait`` comes out alone."""
    return left.withWatermark(left_time, delay).join(
        right.withWatermark(right_time, delay),
        (F.col(left_key) == F.col(right_key)) & joins.within(F.col(right_time), F.col(left_time), wait),
        "full_outer",
    )


def sale_details(
    orders: DataFrame,
    details: DataFrame,
    *,
    order_time: str,
    detail_time: str,
    wait: timedelta = timedelta(days=1),
    delay: str = "10 minutes",
    salts: int = 4,
) -> DataFrame:
    """Orders with details that arrive up to ``wait`` before or after them."""
    return joins.sale_details(
        orders.withWatermark(order_time, delay), details.withWatermark(detail_time, delay),
        order_time, detail_time, wait, salts,
    )
