import datetime as dt
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillcast.functions.stats import filliben_position, normal_ppf
from tillcast.operators import diagnostics, encoding, evaluation, split

D = dt.date


def test_split_sizes_and_ties_at_cut(spark):
    # 10 rows, position 7 falls inside a date shared by several stores
    rows = [(D(2021, 1, d), s, float(d)) for d, ss in ((1, "ab"), (2, "ab"), (3, "abc"), (4, "abc")) for s in ss]
    df = spark.createDataFrame(rows, "date date, store_id string, total_revenue double")
    out = split.chronological_split(df, target="total_revenue").orderBy("position").collect()
    n = len(rows)
    tr, va = int(n * (1 - 0.2 - 0.1)), int(n * 0.1)
    assert [r.split for r in out] == ["train"] * tr + ["validation"] * va + ["test"] * (n - tr - va)
    assert [(r.date, r.store_id) for r in out] == sorted((d, s) for d, s, _ in rows)


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    y, p = rng.normal(100, 10, 50), rng.normal(100, 10, 50)
    df = spark.createDataFrame([(float(a), float(b), "m") for a, b in zip(y, p)], "actual double, prediction double, model string")
    m = {r.metric: r.value for r in evaluation.regression_metrics(df).collect()}
    e = y - p
    assert np.isclose(m["rmse"], np.sqrt(np.mean(e ** 2)))
    assert np.isclose(m["mae"], np.mean(np.abs(e)))
    assert np.isclose(m["r2"], 1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2))


def test_ensemble_weights_floor_and_fallback(spark):
    m = spark.createDataFrame([("a", "r2", 0.9), ("b", "r2", 0.05)], "model string, metric string, value double")
    w = {r.model: r.weight for r in evaluation.ensemble_weights(m).collect()}
    assert abs(sum(w.values()) - 1) < 1e-12 and w["b"] > 0.05
    neg = spark.createDataFrame([("a", "r2", -0.5), ("b", "r2", -0.1)], "model string, metric string, value double")
    assert {r.weight for r in evaluation.ensemble_weights(neg).collect()} == {0.5}


def test_ppf_and_filliben(spark):
    ps = [0.001, 0.02, 0.3, 0.5, 0.9, 0.99]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r.z for r in df.select(normal_ppf("p").alias("z")).collect()]
    assert np.allclose(got, [NormalDist().inv_cdf(p) for p in ps], atol=1e-8)
    n = spark.createDataFrame([(1, 5), (3, 5), (5, 5)], "i int, n int")
    pos = [r.m for r in n.select(filliben_position(F.col("i").cast("double"), F.col("n").cast("double")).alias("m")).collect()]
    last = 0.5 ** (1 / 5)
    assert np.allclose(pos, [1 - last, (3 - 0.3175) / (5 + 0.365), last])


def test_histogram_max_in_last_bin_and_density_integrates(spark):
    vals = [0.0, 1.0, 2.0, 10.0]
    res = spark.createDataFrame([("m", v) for v in vals], "model string, residual double")
    h = diagnostics.error_histogram(res, bins=5).orderBy("bin").collect()
    assert len(h) == 5 and h[-1]["count"] == 1
    assert np.isclose(sum(r.density * (r.bin_end - r.bin_start) for r in h), 1.0)


def test_boxplot_whiskers(spark):
    res = spark.createDataFrame([("m", float(v)) for v in (1, 2, 3, 4, 100)], "model string, residual double")
    b = diagnostics.residual_boxplot(res).first()
    assert (b.q1, b.median, b.q3) == (2.0, 3.0, 4.0)
    assert b.whisker_high == 4.0 and b.outliers == 1


def test_label_encoder_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "store_id string")
    enc = encoding.fit_label_encoder(df, "store_id")
    assert {r.store_id: r.store_id_index for r in enc.collect()} == {"a": 0, "b": 1, "c": 2}
    new = spark.createDataFrame([("z",)], "store_id string")
    try:
        encoding.apply_label_encoder(new, enc, "store_id").collect()
        raised = False
    except Exception:  # noqa: BLE001
        raised = True
    assert raised


def test_scaler_zero_variance_divides_by_one(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    sc = encoding.fit_scaler(df, ["x", "k"])
    s = {r.column: (r.mean, r.std) for r in sc.collect()}
    assert s["x"] == (2.0, 1.0) and s["k"] == (5.0, 1.0)
    out = encoding.apply_scaler(df, sc, ["x", "k"]).collect()
    assert [r.x for r in out] == [-1.0, 1.0] and [r.k for r in out] == [0.0, 0.0]


def test_target_encoding_smoothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "c string, y double")
    enc = {r.c: r.c_target_encoded for r in encoding.fit_target_encoder(df, "y", "c").collect()}
    g = 14 / 3
    assert np.isclose(enc["a"], (2 * 2 + g) / 3) and np.isclose(enc["b"], (10 + g) / 2)


def test_metrics_wide_long_roundtrip_and_report_bundle(spark):
    import tempfile

    from tillcast.sources import files

    m = spark.createDataFrame([("model_a", "rmse", 2.0), ("model_a", "r2", 0.5), ("ensemble", "mae", 1.0)],
                              "model string, metric string, value double")
    wide = evaluation.metrics_wide(m)
    assert set(wide.columns) == {"model_a_rmse", "model_a_r2", "ensemble_mae"}
    back = sorted((r.model, r.metric, r.value) for r in evaluation.metrics_long(wide).collect())
    assert back == sorted((r.model, r.metric, r.value) for r in m.collect())
    root = tempfile.mkdtemp(prefix="tillcast-report-")
    paths = files.write_tables({"metrics": m, "wide": wide}, root)
    assert spark.read.parquet(paths["metrics"]).count() == 3
