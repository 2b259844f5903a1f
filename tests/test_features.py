import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillcast.functions import dates
from tillcast.functions.holidays import is_holiday
from tillcast.operators import features

D = dt.date


def test_calendar_parts_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(D(2021, 1, 1),), (D(2021, 1, 3),)], "date date")
    r = {x.date: x for x in df.select("date", *dates.date_feature_columns()).collect()}
    assert r[D(2021, 1, 1)].weekofyear == 53
    assert r[D(2021, 1, 3)].dayofweek == 6 and r[D(2021, 1, 3)].is_weekend == 1


def test_holidays_known_dates(spark):
    days = [D(2021, 11, 25), D(2021, 7, 5), D(2021, 12, 31), D(2021, 5, 31), D(2021, 6, 18), D(2021, 3, 3)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = {r.date: r.h for r in df.select("date", is_holiday("date").alias("h")).collect()}
    assert got == {D(2021, 11, 25): True, D(2021, 7, 5): True, D(2021, 12, 31): True,
                   D(2021, 5, 31): True, D(2021, 6, 18): True, D(2021, 3, 3): False}


def test_lags_and_rolling_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"date": pd.date_range("2021-01-01", periods=40).date, "store_id": "s",
                        "total_revenue": rng.uniform(10, 100, 40).round(2)})
    df = spark.createDataFrame(pdf)
    w = features.series_window(["store_id"])
    out = df.select("date", "total_revenue", *features.lag_columns("total_revenue", w),
                    *features.rolling_columns("total_revenue", w)).orderBy("date").toPandas()
    s = pdf["total_revenue"]
    assert np.allclose(out["total_revenue_lag_7"], s.shift(7), equal_nan=True)
    for k in (3, 7, 30):
        r = s.rolling(k, min_periods=1)
        assert np.allclose(out[f"total_revenue_rolling_{k}_mean"], r.mean())
        assert np.allclose(out[f"total_revenue_rolling_{k}_median"], r.median())
        assert np.allclose(out[f"total_revenue_rolling_{k}_std"], r.std(), equal_nan=True)
    assert pd.isna(out["total_revenue_rolling_3_std"][0])  # single-row std is missing, as in pandas


def test_ewm_matches_pandas(spark):
    vals = np.random.default_rng(2).uniform(0, 1000, 500)
    pdf = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=500).date, "store_id": "s", "t": vals})
    out = features.with_ewm(spark.createDataFrame(pdf), "t", (7,)).orderBy("date").toPandas()
    assert np.allclose(out["t_ewm_7"], pd.Series(vals).ewm(span=7, adjust=False).mean(), rtol=1e-12)


def test_global_fill_crosses_series_like_pandas(spark):
    rows = []
    for s, vals in (("a", [None, 1.0, None, 2.0]), ("b", [None, None, 3.0, None]), ("c", [None, None, None, None]),
                    ("d", [None, 4.0, None, None])):
        rows += [(D(2021, 1, i + 1), s, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "date date, store_id string, x_lag_1 double")
    got = features.fill_forward_backward(df, ["x_lag_1"], ["store_id"], scope="global").orderBy("store_id", "date")
    pdf = pd.DataFrame(rows, columns=["date", "store_id", "x_lag_1"]).sort_values(["store_id", "date"])
    expect = pdf["x_lag_1"].ffill().bfill().tolist()
    assert [r.x_lag_1 for r in got.collect()] == expect
    grp = features.fill_forward_backward(df, ["x_lag_1"], ["store_id"], scope="group")
    assert grp.where((F.col("store_id") == "c") & F.col("x_lag_1").isNull()).count() == 4


def test_feature_table_has_53_columns(spark):
    from tillcast.plans.registry import store_daily_of

    ft = features.feature_table(store_daily_of(spark, "/root/testdata/sf0.001"))
    assert len(ft.columns) == 53
    lagroll = [c for c in ft.columns if "_lag_" in c or "_rolling_" in c]
    assert ft.where(" OR ".join(f"{c} IS NULL" for c in lagroll)).count() == 0


def test_backward_fill_reads_each_row_once(spark):
    """No frame ends at the last row (it would be read again for every row); ties and leading gaps fill as before."""
    rows = [(s, dt.date(2021, 1, 1) + dt.timedelta(days=i), None if i < 3 or i % 4 == 1 or s == "b" else float(i)) for s in ("a", "b", "c") for i in range(12)]
    df = spark.createDataFrame(rows, "store_id string, date date, x_lag_1 double")
    for scope in ("global", "group"):
        out = features.fill_forward_backward(df, ["x_lag_1"], ["store_id"], scope=scope)
        assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
        table = pd.DataFrame(rows, columns=df.columns)
        filled = table.x_lag_1.ffill().bfill() if scope == "global" else table.groupby("store_id").x_lag_1.transform(lambda x: x.ffill().bfill())
        got = [r.x_lag_1 for r in out.orderBy("store_id", "date").collect()]
        assert out.columns == df.columns and got == [None if pd.isna(x) else x for x in filled]
