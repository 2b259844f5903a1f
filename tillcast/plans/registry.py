"""Registered queries: one per operator family, each over whole driver tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` and has an output spec (see
``spec.py``); ``oracle.py`` holds the DuckDB twin under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators import cleaning
from tillcast.plans.spec import finalize
from tillcast.session import materialize
from tillcast.sources import tables as T

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def query(name: str, spec: str):
    def deco(fn):
        REGISTRY[name] = (fn, spec)
        return fn

    return deco


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn, spec):
        return lambda spark, sf_dir: finalize(fn(spark, sf_dir), spec)

    return {name: bind(fn, spec) for name, (fn, spec) in REGISTRY.items()}


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------
def store_daily_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.build_store_daily(
        T.sales(spark, sf_dir), T.promotions(spark, sf_dir), T.customer_traffic(spark, sf_dir)
    )


# ---------------------------------------------------------------------------
# cleaning (A, J, S11)
# ---------------------------------------------------------------------------
STORE_DAILY_SPEC = (
    "date:date, store_id:string, has_discount:double, total_revenue:double, quantity_sold:double, "
    "profit:double, customer_traffic:double, is_holiday:int"
)


@query("store_daily", STORE_DAILY_SPEC)
def q_store_daily(spark, sf_dir):
    return store_daily_of(spark, sf_dir)


@query(
    "daily_product_sales",
    "date:date, store_id:string, product_id:string, category:string, quantity_sold:bigint, "
    "total_revenue:double, cost:double, discount_percent:double, profit:double, unit_price:double",
)
def q_daily_product_sales(spark, sf_dir):
    return cleaning.daily_product_sales(T.sales(spark, sf_dir))


@query(
    "daily_product_totals",
    "date:date, store_id:string, product_id:string, category:string, total_quantity:bigint, "
    "total_revenue:double, total_cost:double, total_profit:double, has_discount:int",
)
def q_daily_product_totals(spark, sf_dir):
    return cleaning.daily_product_totals(T.sales(spark, sf_dir))


@query("promotion_summary", "date:date, product_id:string, discount_percent:double, has_discount:int")
def q_promotion_summary(spark, sf_dir):
    return cleaning.promotion_summary(T.promotions(spark, sf_dir))


@query(
    "sales_with_promotions",
    "date:date, store_id:string, product_id:string, category:string, total_revenue:double, has_discount:double",
)
def q_sales_with_promotions(spark, sf_dir):
    daily = cleaning.daily_product_sales(T.sales(spark, sf_dir))
    return cleaning.with_promotions(daily, cleaning.promotion_summary(T.promotions(spark, sf_dir)))


@query("traffic_summary", "date:date, store_id:string, customer_traffic:bigint, is_holiday:int")
def q_traffic_summary(spark, sf_dir):
    return cleaning.traffic_summary(T.customer_traffic(spark, sf_dir))


@query(
    "sales_with_traffic",
    "date:date, store_id:string, product_id:string, total_revenue:double, customer_traffic:double, "
    "traffic_was_missing:boolean",
)
def q_sales_with_traffic(spark, sf_dir):
    daily = cleaning.daily_product_sales(T.sales(spark, sf_dir))
    joined = cleaning.with_traffic(daily, cleaning.traffic_summary(T.customer_traffic(spark, sf_dir)))
    joined = joined.withColumn("traffic_was_missing", F.col("customer_traffic").isNull())
    # the median pass and the fill read the same join: write the used columns once
    used = joined.select("date", "store_id", "product_id", "total_revenue", "customer_traffic", "traffic_was_missing")
    return cleaning.fill_with_median(materialize(used), "customer_traffic")


@query("dataset_profile", "dataset:string, rows:bigint, columns:int")
def q_dataset_profile(spark, sf_dir):
    return cleaning.dataset_profile(
        {
            "sales": T.sales(spark, sf_dir),
            "promotions": T.promotions(spark, sf_dir),
            "customer_traffic": T.customer_traffic(spark, sf_dir),
            "store_events": T.store_event_intervals(spark, sf_dir),
        }
    )
