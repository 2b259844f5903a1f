"""Promotions, store events and demand factors as the tables show them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.holidays import is_holiday
from tillcast.operators.cleaning import round_money


def promotion_days(promotions: DataFrame) -> DataFrame:
    """Per day and type with a promotion: the largest discount."""
    return (
        promotions.groupBy(F.to_date("date").alias("date"), "promotion_type")
        .agg(F.max("discount_percent").alias("discount_percent"))
        .where(F.col("date").isNotNull())
    )


def expand_intervals(intervals: DataFrame) -> DataFrame:
    """(store, start, duration, type, impact) → one row per store-day."""
    d = F.explode(F.sequence(F.col("start_date"), F.date_add("start_date", F.col("duration_days") - 1)))
    return intervals.select("store_id", d.alias("date"), "event_type", "impact")


def store_event_factor(store_days: DataFrame, event_days: DataFrame) -> DataFrame:
    """Demand factor 1 + impact of the store's event that day (strongest first), else 1."""
    ev = event_days.groupBy("store_id", "date").agg(F.min("impact").alias("impact"))
    out = store_days.join(ev, ["store_id", "date"], "left")
    return out.withColumn("event_factor", F.coalesce(1 + F.col("impact"), F.lit(1.0))).drop("impact")


def demand_factors(sales: DataFrame) -> DataFrame:
    """Per day, how revenue on its weekday, in its month and on holidays compares with the average day.

    Measured on daily totals (windows over one row per day); NULL where
    there is no revenue to compare with.
    """
    daily = sales.groupBy("date").agg(round_money(F.sum("revenue")).alias("_r")).where(F.col("date").isNotNull())
    overall = F.avg("_r").over(Window.partitionBy(F.lit(0)))

    def factor(key: Column) -> Column:
        return F.try_divide(F.avg("_r").over(Window.partitionBy(key)), overall)

    return daily.select(
        "date",
        factor(F.weekday("date")).alias("dow_factor"),
        factor(F.month("date")).alias("month_factor"),
        F.when(is_holiday("date"), factor(is_holiday("date"))).otherwise(1.0).alias("holiday_factor"),
    )


def clamp(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value (``lo``/``hi`` optional)."""
    if hi is not None:
        c = F.least(c, F.lit(hi))
    if lo is not None:
        c = F.greatest(c, F.lit(lo))
    return c
