"""Cleaning: key-grain aggregations and the left joins that build ``store_daily``.

Plan shape (see ``explain``): every aggregate is partial (map-side) + final,
so a hot key collapses to one row per map task before it is shuffled.  Both
lookup tables (promotions, traffic) are reduced to their join key first, so
the left joins are many-to-one and never fan out.  The global median used for
imputation is a scalar subquery (computed once, no cross join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.ordered import exact_quantiles

MONEY_UNIT = 10_000.0  # amounts are kept to 1e-4 currency units


def round_money(c: F.Column) -> F.Column:
    """Snap a money amount to 1e-4 units (``round(x·10⁴)/10⁴``).

    Sums of 4-decimal amounts are exact decimals; floating partial sums add
    noise whose last bits depend on the (nondeterministic) order in which
    partial aggregates merge.  Snapping restores the exact amount, so reruns
    and downstream windows see identical values.
    """
    return F.round(c * F.lit(MONEY_UNIT), 0) / F.lit(MONEY_UNIT)


def _sum0(col: str) -> F.Column:
    """Sum where an all-null group gives 0 (pandas semantics)."""
    return F.coalesce(F.sum(col), F.lit(0))


def daily_product_sales(sales: DataFrame) -> DataFrame:
    """Date × store × product × category totals; null keys are dropped."""
    keys = ["date", "store_id", "product_id", "category"]
    return (
        sales.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            _sum0("quantity_sold").alias("quantity_sold"),
            _sum0("revenue").alias("total_revenue"),
            _sum0("cost").alias("cost"),
            F.avg("discount_percent").alias("discount_percent"),
            _sum0("profit").alias("profit"),
            F.avg("unit_price").alias("unit_price"),
        )
    )


def daily_product_totals(sales: DataFrame) -> DataFrame:
    """All-sums variant with ``total_*`` names and an integer discount flag."""
    keys = ["date", "store_id", "product_id", "category"]
    return (
        sales.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            _sum0("quantity_sold").alias("total_quantity"),
            _sum0("revenue").alias("total_revenue"),
            _sum0("cost").alias("total_cost"),
            _sum0("profit").alias("total_profit"),
            F.max((F.col("discount_percent") > 0).cast("int")).alias("has_discount"),
        )
    )


def promotion_summary(promotions: DataFrame, exact_ts: bool = False) -> DataFrame:
    """A03 + P03: best discount per (day, product) and a constant flag.

    Promotion dates may carry a time of day; by default both join sides are
    compared as dates (``exact_ts=True`` keeps the timestamp and so only
    matches midnight promotions).
    """
    d = F.col("date") if exact_ts else F.to_date("date")
    return (
        promotions.dropna(subset=["date", "product_id"])
        .groupBy(d.alias("date"), "product_id")
        .agg(F.max("discount_percent").alias("discount_percent"))
        .withColumn("has_discount", F.lit(1))
    )


def with_promotions(daily: DataFrame, promo_summary: DataFrame) -> DataFrame:
    """Left join on (date, product_id); no promotion → 0."""
    p = promo_summary.select("date", "product_id", "has_discount")
    return daily.join(p, ["date", "product_id"], "left").withColumn(
        "has_discount", F.coalesce(F.col("has_discount"), F.lit(0)).cast("double")
    )


def traffic_summary(traffic: DataFrame) -> DataFrame:
    """Visits summed and holiday flag OR-ed per (day, store)."""
    return (
        traffic.dropna(subset=["date", "store_id"])
        .groupBy(F.to_date("date").alias("date"), "store_id")
        .agg(
            _sum0("customer_traffic").alias("customer_traffic"),
            F.max(F.col("is_holiday").cast("int")).alias("is_holiday"),
        )
    )


def with_traffic(daily: DataFrame, traffic_sum: DataFrame) -> DataFrame:
    """Left join on (date, store_id); unmatched days keep NULL traffic."""
    return daily.join(traffic_sum, ["date", "store_id"], "left")


def fill_with_median(df: DataFrame, col: str, weight: str | None = None) -> DataFrame:
    """Replace NULLs by the global (optionally row-weighted) median.

    The median is exact and never gathers the values in one task (value
    counts with bucketed running totals); it is read as a scalar subquery.
    """
    med = exact_quantiles(df, col, [0.5], weight).select("q_0").scalar()
    return df.withColumn(col, F.coalesce(F.col(col).cast("double"), med))


def store_daily(daily_sales: DataFrame, promo_summary: DataFrame, traffic_sum: DataFrame,
                materialize: bool = True) -> DataFrame:
    """The modelling grain (date × store).

    Traffic and holiday depend only on (date, store), so the rollup runs
    *before* the traffic join: the join then touches one row per store-day
    instead of one per product line.  The median that fills missing traffic is
    weighted by the number of product rows per store-day, which equals the
    median over the product-grain join.
    """
    dp = with_promotions(daily_sales, promo_summary)
    rolled = dp.groupBy("date", "store_id").agg(
        F.avg("has_discount").alias("has_discount"),
        round_money(_sum0("total_revenue")).alias("total_revenue"),
        _sum0("quantity_sold").cast("double").alias("quantity_sold"),
        round_money(_sum0("profit")).alias("profit"),
        F.count(F.lit(1)).alias("_rows"),
    )
    joined = with_traffic(rolled, traffic_sum)
    if materialize:
        # store-day grain (small); the median pass and the output then share one upstream run
        from tillcast.session import materialize as _checkpoint

        joined = _checkpoint(joined)
    filled = fill_with_median(joined, "customer_traffic", weight="_rows")
    return filled.select(
        "date", "store_id", "has_discount", "total_revenue", "quantity_sold", "profit",
        "customer_traffic", F.col("is_holiday").cast("int").alias("is_holiday"),
    )


def build_store_daily(sales: DataFrame, promotions: DataFrame, traffic: DataFrame) -> DataFrame:
    """A01 → A03/J01 → A04/J02/A06 → A05; the store-day join is written once on the way."""
    return store_daily(daily_product_sales(sales), promotion_summary(promotions), traffic_summary(traffic))


def dataset_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and column count per dataset, one row each (union of counts)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
