import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import forecast, ordered, quality, rules

D = dt.date


def test_gap_report_and_global_gaps(spark):
    df = spark.createDataFrame([(D(2021, 1, 1), "s"), (D(2021, 1, 2), "s"), (D(2021, 1, 5), "s")], "date date, store_id string")
    g = quality.gap_report(df, ["store_id"]).first()
    assert (g.gap_count, g.max_gap_days) == (1, 3)
    assert quality.gaps(df).first().gap_after == D(2021, 1, 2)


def test_duplicates_casts_ranges_outliers(spark):
    rows = [("a", "1.5", 10.0), ("a", "1.5", 10.0), ("b", "x", 2_000_000.0)] + [("c", "2", float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, s string, total_revenue double")
    assert quality.duplicate_rows(df).first().duplicate_rows == 1
    tc = {r.column: r.failed for r in quality.type_check(df, {"s": "double"}).collect()}
    assert tc == {"s": 1}
    rb = {r.check: r.breached for r in quality.range_breaches(df).collect()}
    assert rb == {"below_minimum": False, "above_maximum": True}
    assert quality.outlier_counts(df, "iqr", ["total_revenue"]).first().outliers == 1


def test_missing_column_issue(spark):
    df = spark.createDataFrame([(D(2021, 1, 1), 1.0)], "date date, total_revenue double")
    assert {r.column for r in quality.missing_columns(spark, df).collect()} == {"store_id", "product_id"}


def test_ks_statistic(spark):
    from tillcast.operators.ordered import ks_statistic

    a = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    b = spark.createDataFrame([(float(i) + 5,) for i in range(10)], "v double")
    assert abs(ks_statistic(a, b, "v").first().ks - 0.5) < 1e-12


def test_short_history_falls_back_to_mean(spark):
    hist = spark.createDataFrame([(D(2021, 1, i), "store_007", float(i)) for i in range(1, 6)],
                                 "date date, store_id string, total_revenue double")
    ff = forecast.forecast_frame(hist, horizon=3).orderBy("date").collect()
    assert len(ff) == 3 and ff[0].date == D(2021, 1, 6)
    r = ff[0]
    assert r.total_revenue_lag_1 == 5.0 and r.total_revenue_lag_7 == 3.0        # mean fallback
    assert r.total_revenue_rolling_3_mean == 4.0 and r.total_revenue_rolling_7_std == 0.0
    assert r.quantity_sold == 100 and r.customer_traffic == 500


def test_store_number_and_unknown_store(spark):
    df = spark.createDataFrame([("store_012",), ("main",)], "store_id string")
    assert [r.n for r in df.select(forecast.store_number("store_id").alias("n")).collect()] == [12, 1]
    known = spark.createDataFrame([("store_002",), ("store_001",)], "store_id string")
    got = forecast.map_unknown(spark.createDataFrame([("store_999",)], "store_id string"), "store_id", known)
    assert got.first().store_id == "store_001"


def test_demand_factors_and_promotion_days(spark):
    days = [D(2021, 6, 7) + dt.timedelta(days=i) for i in range(14)]  # two weeks from a Monday
    df = spark.createDataFrame([(d, 20.0 if d.weekday() == 5 else 10.0) for d in days] + [(None, 5.0)], "date date, revenue double")
    got = {r.date: r for r in rules.demand_factors(df).collect()}
    mean = (12 * 10 + 2 * 20) / 14
    assert len(got) == 14 and abs(got[days[5]].dow_factor - 20 / mean) < 1e-12 and got[days[0]].month_factor == 1.0
    promos = spark.createDataFrame([(dt.datetime(2021, 1, 1, 16), "m", 0.1), (dt.datetime(2021, 1, 1), "m", 0.2)],
                                   "date timestamp, promotion_type string, discount_percent double")
    assert [tuple(r) for r in rules.promotion_days(promos).collect()] == [(D(2021, 1, 1), "m", 0.2)]


def test_edge_cases_do_not_raise(spark):
    from tillcast.operators import evaluation, features
    from tillcast.operators.ordered import ks_statistic, label_index

    constant = spark.createDataFrame([(5.0, "a")] * 4, "x double, s string")
    assert quality.outlier_counts(constant, "zscore", ["x"]).first().outliers == 0
    empty = constant.limit(0)
    profile = {(r.column, r.metric): r.value for r in quality.column_profile(empty).collect()}
    assert profile["x", "null_count"] == 0 and profile["x", "null_percentage"] is None and profile["s", "unique_values"] == 0
    assert quality.outlier_counts(empty, "iqr", ["x"]).first().outliers == 0
    assert ks_statistic(constant, empty, "x").first().ks is None
    preds = spark.createDataFrame([("m", 5.0, 5.0), ("m", 5.0, 5.0), ("n", 5.0, 4.0), ("n", 5.0, 5.0)],
                                  "model string, actual double, prediction double")
    r2 = {r.model: r.value for r in evaluation.regression_metrics(preds).where("metric = 'r2'").collect()}
    assert r2 == {"m": 1.0, "n": 0.0}
    long = spark.createDataFrame([("store_99999999999",)], "store_id string")
    assert long.select(forecast.store_number("store_id").alias("n")).first().n is None
    pair = spark.createDataFrame([("a", None)], "p string, q string").select(*features.interaction_columns(["p", "q"]))
    assert pair.first()[0] == "a_nan"
    labels = spark.createDataFrame([(f"s{i % 50:03d}",) for i in range(300)] + [(None,)], "s string")
    assert sorted((r.s, r.s_index) for r in label_index(labels, "s").collect()) == [(f"s{i:03d}", i) for i in range(50)]


def test_ewm_with_gaps(spark):
    import pandas as pd

    rows = [(D(2021, 1, i + 1), s, v) for s, vs in (("a", [1.0, None, 9.0]), ("b", [None, 2.0, 4.0])) for i, v in enumerate(vs)]
    from tillcast.operators import features

    got = features.with_ewm(spark.createDataFrame(rows, "date date, store_id string, x double"), "x", (7,)).collect()
    want = {(d, s): v for s in "ab" for (d, _, _), v in zip([r for r in rows if r[1] == s],
            pd.Series([r[2] for r in rows if r[1] == s]).ewm(span=7, adjust=False).mean())}
    for r in got:
        w = want[r.date, r.store_id]
        assert (r.x_ewm_7 is None and pd.isna(w)) or abs(r.x_ewm_7 - w) < 1e-12


def test_long_horizon_and_grouped_ranks(spark):
    from tillcast.operators.ordered import grouped_quantiles, ranks

    hist = spark.createDataFrame([(D(2021, 1, 1), "s", 1.0)], "date date, store_id string, total_revenue double")
    assert forecast.forecast_frame(hist, horizon=120).count() == 120
    df = spark.createDataFrame([(None if i % 7 == 0 else f"g{i % 3}", float(i * 37 % 101), i) for i in range(900)], "g string, v double, k int")
    got = {r.k: (r.rank, r.n) for r in ranks(df, ["g"], "v", ["k"]).collect()}
    rows = df.collect()
    for g in (None, "g0", "g1", "g2"):
        mine = sorted((r.v, r.k) for r in rows if r.g == g)
        assert [got[k] for _, k in mine] == [(i + 1, len(mine)) for i in range(len(mine))]
    q = {r.g: (r.q_0, r.q_1) for r in grouped_quantiles(df, ["g"], "v", [0.1, 0.5]).collect()}
    ref = {r.g: tuple(r.q) for r in df.groupBy("g").agg(F.percentile("v", [0.1, 0.5]).alias("q")).collect()}
    assert q.keys() == ref.keys() and all(abs(a - b) < 1e-9 for g in ref for a, b in zip(q[g], ref[g]))


def test_distributed_quantiles_equal_builtin(spark):
    from tillcast.operators.ordered import exact_quantiles

    df = spark.createDataFrame([(float(x % 37) * 1.5, 1 + x % 3) for x in range(500)], "v double, w long")
    got = exact_quantiles(df, "v", [0.25, 0.5, 0.75]).first()
    ref = df.agg(F.percentile("v", [0.25, 0.5, 0.75])).first()[0]
    assert [got.q_0, got.q_1, got.q_2] == ref
    wq = exact_quantiles(df, "v", [0.5], "w").first().q_0
    assert wq == df.agg(F.percentile("v", 0.5, F.col("w"))).first()[0]
    flagged = quality.outlier_counts(df, "iqr", ["v"]).first().outliers
    lo, hi = ref[0] - 1.5 * (ref[2] - ref[0]), ref[2] + 1.5 * (ref[2] - ref[0])
    assert flagged == df.where((F.col("v") < lo) | (F.col("v") > hi)).count()


def test_value_ranges_run_compiled(spark):
    """A row's range takes halvings in compiled code; lambda functions over the bounds were interpreted for every row."""
    rows = [(g, float((i * 7919) % 1000) if i % 11 else None, i % 3) for g in ("a", "b", None) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    ranged = ordered._ranged(df, ["g"], "v")
    assert "lambdafunction" not in ranged._jdf.queryExecution().optimizedPlan().toString()
    by_range = {}
    for r in ranged.collect():
        by_range.setdefault((r.g, r._b), []).append(r.v)
    for g in ("a", "b", None):
        spans = [(min(vs), max(vs)) for (h, b), vs in sorted(by_range.items(), key=lambda x: x[0][1]) if h == g and b]
        assert len(spans) > 200 and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_quantiles_of_groups_with_weights(spark):
    """Only ranges that hold a wanted rank are put in order; hot values, single rows and weights of 0 change nothing."""
    rows = [("a", float((i * 7919) % 997), i % 4) for i in range(4000)] + [("hot", 5.0, 2)] * 500 + [("hot", float(i), 1) for i in range(600)]
    rows += [("one", -3.0, 1), ("none", 1.0, 0), (None, 2.0, 1), (None, 4.0, 1), ("a", None, 9)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = {r.g: [r[f"q_{i}"] for i in range(len(probs))] for r in ordered.grouped_quantiles(df, ["g"], "v", probs, "w").collect()}
    assert set(found) == {"a", "hot", "one", None}
    for g, qs in found.items():
        values = np.repeat(*map(np.array, zip(*[(v, w) for h, v, w in rows if h == g and v is not None])))
        assert qs == pytest.approx(np.quantile(values, probs).tolist())
    whole = df.where("w > 0").select("v")
    assert ordered.exact_quantiles(whole, "v", [0.5]).first()[0] == whole.agg(F.percentile("v", 0.5)).first()[0]
