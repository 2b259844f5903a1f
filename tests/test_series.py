"""Positions, blocked windows and affine scans along series against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillcast.config import FeatureConfig
from tillcast.operators import features, series


def _rows(n=600, seed=3):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({
        "store_id": rng.choice(["hot", "hot", "hot", "b", None], n), "t": rng.permutation(n) // 3,
        "x": np.where(rng.random(n) < 0.3, np.nan, rng.uniform(-50, 100, n).round(3)), "row": np.arange(n),
    })
    return frame


def _spark_rows(spark, frame):
    rows = [(s, int(t), None if np.isnan(x) else float(x), int(k)) for s, t, x, k in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, "store_id string, t int, x double, row int").repartition(5)


def test_positions_count_every_row_once(spark):
    df = _spark_rows(spark, _rows())
    for keys in ([], ["store_id"]):
        got = series.positions(df, keys, ["t"]).toPandas()
        assert len(got) == 600
        groups = got.groupby(got["store_id"].fillna("none")) if keys else [("all", got)]
        for _, one in groups:
            one = one.sort_values("_pos")
            assert one["_pos"].tolist() == list(range(len(one))) and one["t"].is_monotonic_increasing


@pytest.mark.parametrize("keys", [["store_id"], []])
@pytest.mark.parametrize("block", [4, 1024])
def test_ewm_in_blocks_equals_pandas(spark, keys, block):
    """NULL gaps, leading NULLs, repeated days, a null key; blocks of blocks where they are small."""
    df = _spark_rows(spark, _rows())
    got = series.ewm(df, "x", (7, 14), keys, ["t", "row"], block).toPandas()
    assert len(got) == 600 and sorted(got["row"]) == list(range(600))
    for _, one in got.groupby(got["store_id"].fillna("none")) if keys else [("all", got)]:
        one = one.sort_values(["t", "row"])
        for span in (7, 14):
            want = one["x"].ewm(span=span, adjust=False).mean()
            assert np.allclose(one[f"x_ewm_{span}"], want, rtol=1e-11, atol=1e-11, equal_nan=True)


def test_ewm_edge_cases(spark):
    schema = "store_id string, t int, x double"
    assert series.ewm(spark.createDataFrame([], schema), "x", (7,), ["store_id"], ["t"]).count() == 0
    rows = [("a", 1, None), ("a", 2, None), ("b", 1, float("nan")), ("b", 2, 4.0), ("b", 2, 4.0), ("c", None, 1.0)]
    got = series.ewm(spark.createDataFrame(rows, schema), "x", (7,), ["store_id"], ["t"], 2).collect()
    assert len(got) == 6
    assert sorted((r.store_id, r.x_ewm_7) for r in got if r.x_ewm_7 is not None) == [("b", 4.0), ("b", 4.0), ("c", 1.0)]
    gap = [("a", k, 1.0 if k in (0, 399) else None) for k in range(400)]  # a weight of next to nothing
    assert {r.x_ewm_7 for r in series.ewm(spark.createDataFrame(gap, schema), "x", (7,), ["store_id"], ["t"], 64).collect()} == {1.0}


def test_repeated_days_keep_their_rows(spark):
    rows = [("s", 1, 5.0), ("s", 1, 5.0), ("s", 2, 7.0)]
    df = spark.createDataFrame(rows, "store_id string, date int, x double")
    assert features.with_ewm(df, "x", (7,)).count() == 3


@pytest.mark.parametrize("keys", [["store_id"], []])
def test_blocked_windows_equal_whole_ones(spark, keys):
    df = _spark_rows(spark, _rows())

    def build(w, place):
        return [place.alias("place"), *features.lag_columns("x", w, (1, 9)), *features.rolling_columns("x", w, (3, 10))]

    whole = series.windowed(df, keys, ["t", "row"], build, 9)
    for block in (40,):
        cut = series.windowed(df, keys, ["t", "row"], build, 9, block)
        assert cut.columns == whole.columns
        a, b = (x.orderBy("row").toPandas() for x in (whole, cut))
        pd.testing.assert_frame_equal(a, b)


def test_no_window_holds_a_whole_series(spark):
    df = _spark_rows(spark, _rows())
    seen = series.windowed(df, [], ["t", "row"], lambda w, place: [F.count("*").over(w.rowsBetween(-10**6, 10**6)).alias("n")], 9, 40)
    assert seen.agg(F.max("n")).first()[0] <= 49
    with pytest.raises(ValueError):
        series.windowed(df, [], ["t"], lambda w, place: [], 50, 40)


def test_time_series_features_in_blocks(spark):
    days = pd.date_range("2020-01-01", periods=200).date
    rng = np.random.default_rng(1)
    rows = [(d, s, float(v)) for s in ("a", "b") for d, v in zip(days, rng.uniform(0, 9, 200))]
    df = spark.createDataFrame(rows, "date date, store_id string, total_revenue double")
    for keys in (("store_id",), ()):
        src = df if keys else df.where("store_id = 'a'")
        cfg = FeatureConfig(group_cols=keys)
        whole = features.time_series_features(src, cfg).orderBy("store_id", "date").toPandas()
        cut = features.time_series_features(src, cfg, block_rows=50).orderBy("store_id", "date").toPandas()
        pd.testing.assert_frame_equal(whole, cut)
