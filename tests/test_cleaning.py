import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from tillcast.operators import cleaning

D = dt.date


def test_null_keys_dropped_and_all_null_sum_is_zero(spark):
    rows = [
        (D(2021, 1, 1), "store_001", "p1", "A", 1, 10.0, 5.0, 0.1, 5.0, 10.0),
        (D(2021, 1, 1), None, "p1", "A", 1, 10.0, 5.0, 0.1, 5.0, 10.0),
        (D(2021, 1, 1), "store_002", "p2", "A", 2, None, None, None, None, 10.0),
    ]
    sales = spark.createDataFrame(
        rows, "date date, store_id string, product_id string, category string, quantity_sold long, revenue double, "
              "cost double, discount_percent double, profit double, unit_price double")
    out = {r.store_id: r for r in cleaning.daily_product_sales(sales).collect()}
    assert set(out) == {"store_001", "store_002"}          # null key dropped (pandas groupby)
    assert out["store_002"].total_revenue == 0              # all-null sum → 0
    assert out["store_002"].discount_percent is None        # mean of nothing stays missing


def test_flash_sale_time_of_day_matches_by_date(spark):
    promo = spark.createDataFrame([(dt.datetime(2021, 6, 1, 16, 0), "p1", "flash", 0.2)],
                                  "date timestamp, product_id string, promotion_type string, discount_percent double")
    daily = spark.createDataFrame([(D(2021, 6, 1), "s", "p1")], "date date, store_id string, product_id string")
    by_date = cleaning.with_promotions(daily, cleaning.promotion_summary(promo)).first()
    assert by_date.has_discount == 1.0
    exact = cleaning.promotion_summary(promo, exact_ts=True).withColumn("date", F.to_date("date"))
    # the exact-timestamp variant keeps 16:00, which never equals a midnight sales date
    assert cleaning.promotion_summary(promo, exact_ts=True).first().date.hour == 16
    assert exact.count() == 1


def test_store_daily_weighted_median_equals_product_grain_median(spark):
    daily = spark.createDataFrame(
        [(D(2021, 1, d), s, p, "A", 1, 10.0 * d, 1.0, 0.0, 2.0, 1.0)
         for d in (1, 2, 3) for s in ("s1", "s2") for p in (("p1", "p2", "p3") if s == "s1" else ("p1",))],
        "date date, store_id string, product_id string, category string, quantity_sold long, total_revenue double, "
        "cost double, discount_percent double, profit double, unit_price double")
    promo = spark.createDataFrame([], "date date, product_id string, discount_percent double, has_discount int")
    traffic = spark.createDataFrame([(D(2021, 1, 1), "s1", 100, 0), (D(2021, 1, 1), "s2", 7, 1),
                                     (D(2021, 1, 2), "s2", 9, 0)],
                                    "date date, store_id string, customer_traffic long, is_holiday int")
    out = cleaning.store_daily(daily, promo, traffic).toPandas()
    pdf = daily.toPandas().merge(traffic.toPandas(), on=["date", "store_id"], how="left")
    med = pdf["customer_traffic"].median()
    filled = out.set_index(["date", "store_id"])["customer_traffic"]
    assert filled[(D(2021, 1, 3), "s1")] == med
    assert filled[(D(2021, 1, 1), "s1")] == 100
    assert len(out) == 6
