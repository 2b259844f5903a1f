import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillcast.operators import backtest, forecast
from tillcast.operators.split import time_series_folds

START = dt.date(2021, 1, 4)
SCHEMA = "date date, store_id string, total_revenue double"


def _days(*offsets):
    return [START + dt.timedelta(o) for o in offsets]


def test_folds_by_hand_in_pandas(spark):
    rng = np.random.default_rng(7)
    rows = [(d, s, float(rng.integers(1, 100))) for d in _days(*range(50)) for s in ("a", "b", None) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.fold, r.date, r.store_id, r.model): r for r in backtest.rolling_origin(df, 4).collect()}
    frame = pd.DataFrame(rows, columns=["date", "store_id", "y"]).fillna({"store_id": "-"})
    blocks = {(r.fold, r.date): r.role for r in time_series_folds(df, 4).collect()}
    count = 0
    for fold in range(1, 5):
        role = frame["date"].map(lambda d: blocks.get((fold, d)))
        train, held = frame[role == "train"], frame[role == "validation"]
        end = train["date"].max()
        for row in held.itertuples():
            mine = train[train["store_id"] == row.store_id].sort_values("date")
            same = mine[[d.weekday() == row.date.weekday() for d in mine["date"]]]
            want = {"last_value": mine["y"].iloc[-1], "series_mean": mine["y"].mean(),
                    "weekday_mean": same["y"].mean() if len(same) else None}
            for model, value in want.items():
                r = got[fold, row.date, None if row.store_id == "-" else row.store_id, model]
                assert r.actual == row.y and r.horizon == (row.date - end).days
                assert r.prediction is None if value is None else math.isclose(r.prediction, value)
                count += 1
    assert count == len(got)


def test_backtest_edges(spark):
    rows = [(d, "old", 1.0) for d in _days(0, 1, 2)] + [(START + dt.timedelta(3), "new", 5.0), (None, "old", 9.0), (START, "x", None)]
    got = {(r.fold, r.store_id, r.model): r.prediction for r in backtest.rolling_origin(spark.createDataFrame(rows, SCHEMA), 1).collect()}
    assert got[1, "old", "last_value"] == 1.0 and got[1, "new", "last_value"] is None  # not known before
    metrics = backtest.fold_metrics(backtest.rolling_origin(spark.createDataFrame(rows, SCHEMA), 1))
    assert metrics.where("model = 'last_value' AND metric = 'mae'").first().value == 0.0
    assert backtest.rolling_origin(spark.createDataFrame([], SCHEMA), 3).count() == 0
    with pytest.raises(ValueError):
        backtest.rolling_origin(spark.createDataFrame([], SCHEMA), 0)


def test_conformal_widths_are_the_order_statistic(spark):
    rng = np.random.default_rng(3)
    rows = [("m", s, float(x)) for s, n in (("big", 400), ("tiny", 3)) for x in rng.normal(0, 10, n).round(1)]
    rows += [("m", "big", None)]
    df = spark.createDataFrame(rows, "model string, store_id string, residual double")
    got = {r.store_id: r for r in forecast.conformal_widths(df).collect()}
    for store, n in (("big", 400), ("tiny", 3)):
        a = sorted(abs(x) for _, s, x in rows if s == store and x is not None)
        assert got[store].n == n
        for level, width in ((0.8, got[store].width_80), (0.95, got[store].width_95)):
            k = math.ceil((n + 1) * level - 1e-9)
            assert width == (a[k - 1] if k <= n else None)


def test_intervals_cover_new_values_and_fall_back_to_the_pool(spark):
    rng = np.random.default_rng(11)
    held = spark.createDataFrame([("m", s, float(x)) for s, spread in (("a", 1), ("b", 20)) for x in rng.normal(0, spread, 1500)],
                                 "model string, store_id string, residual double")
    new = [("m", s, 100.0, 100.0 + float(x)) for s, spread in (("a", 1), ("b", 20)) for x in rng.normal(0, spread, 3000)]
    preds = spark.createDataFrame(new, "model string, store_id string, predicted_sales double, actual double")
    out = forecast.with_intervals(preds, held)
    for level in (80, 95):
        inside = out.groupBy("store_id").agg(F.avg(F.col("actual").between(F.col(f"lower_{level}"), F.col(f"upper_{level}")).cast("int")).alias("x"))
        assert all(abs(r.x - level / 100) < 0.03 for r in inside.collect())
    unknown = spark.createDataFrame([("m", "c", 5.0), ("other", "a", 5.0), (None, None, 5.0)], "model string, store_id string, predicted_sales double")
    got = {r.model: r for r in forecast.with_intervals(unknown, held).collect()}
    pool = forecast.conformal_widths(held, ["model"]).first()
    assert got["m"].upper_80 == 5.0 + pool.width_80 and got["other"].upper_80 is None and got[None].lower_95 is None
    assert forecast.with_intervals(unknown, held.where("false")).where("lower_80 IS NULL").count() == 3
