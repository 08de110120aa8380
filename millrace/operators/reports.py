"""Dashboard numbers over the daily-active and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Id and display name of the dashboard's daily-active number.
DAU_KPI = ("dau", "新增日活")


def dau_total(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Active devices per day, or of one ``day``."""
    rows = dau.where(F.col("logDate") == day) if day else dau
    return rows.groupBy("logDate").agg(F.count("*").alias("total"))


def dau_hourly(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Devices by the hour of their first start, per day."""
    rows = dau.where(F.col("logDate") == day) if day else dau
    return rows.groupBy("logDate", "logHour").agg(F.count("*").alias("ct"))


def dau_hourly_map(dau: DataFrame, day: str | None = None) -> DataFrame:
    """One row per day with a map hour -> devices (24 entries at most)."""
    entries = F.array_sort(F.collect_list(F.struct("logHour", "ct")))
    return dau_hourly(dau, day).groupBy("logDate").agg(F.map_from_entries(entries).alias("hours"))


def kpis(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Dashboard rows ``id, name, value``, per day."""
    total = dau_total(dau, day)
    return total.select(
        "logDate", F.lit(DAU_KPI[0]).alias("id"), F.lit(DAU_KPI[1]).alias("name"),
        F.col("total").alias("value"),
    )


def gmv_by_hour(orders: DataFrame) -> DataFrame:
    return orders.groupBy("create_date", "create_hour").agg(
        F.sum(F.col("total_amount").cast("decimal(16,2)")).alias("gmv"), F.count("*").alias("order_ct")
    )
