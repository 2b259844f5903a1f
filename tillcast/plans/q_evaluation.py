"""Registered split / evaluation / diagnostics queries (O, M06–M09, R, V17, V19, V20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.config import CONFIDENCE_LEVELS, ENSEMBLE_MIN_WEIGHT, FORECAST_BAND, HISTOGRAM_BINS, IQR_MULTIPLIER, KS_THRESHOLD, RMSE_ALERT
from tillcast.functions.stats import normal_ppf_sql
from tillcast.operators import backtest, diagnostics, evaluation, features, forecast, ordered, quality, split
from tillcast.plans.oracle import BASE, sql
from tillcast.plans.q_features import FEATURE_FRAME_SQL
from tillcast.plans.registry import query, store_daily_of
from tillcast.session import materialize

TRAIN_FRAC, VAL_FRAC = split.split_fractions()
DRIFT_COLS = ["has_discount", "total_revenue", "quantity_sold", "profit", "customer_traffic"]


def _d(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


# --- shared Spark inputs -----------------------------------------------------------------
def labeled_of(days):
    return split.chronological_split(features.feature_table(days), target="total_revenue")


def labeled(spark, sf_dir):
    return labeled_of(store_daily_of(spark, sf_dir))


def predictions(spark, sf_dir):
    return evaluation.naive_predictions(labeled(spark, sf_dir))


def evaluated(spark, sf_dir):
    """(naive predictions, validation weights, test predictions incl. ensemble, all metrics).

    The prediction table and the per-model tables are checkpointed: each is
    read by several later steps (metrics, weights, ensemble, diagnostics),
    and re-embedding their plans in every consumer multiplies the plan tree.
    """
    preds = materialize(predictions(spark, sf_dir))
    scored = preds.where(F.col("split").isin("validation", "test"))
    naive_m = materialize(evaluation.regression_metrics(scored, ["split", "model"]))
    weights = materialize(evaluation.ensemble_weights(naive_m.where(F.col("split") == "validation")))
    test = preds.where(F.col("split") == "test")
    ens = materialize(evaluation.ensemble_predictions(test, weights))
    ens_m = evaluation.regression_metrics(ens, ["split", "model"])
    return preds, weights, test.unionByName(ens), naive_m.unionByName(ens_m)


# --- shared SQL ------------------------------------------------------------------------------
def _metrics_sql(src: str, name: str) -> str:
    e = "(p.actual - p.prediction)"
    return f"""{name}_m AS (SELECT split, model, avg(actual) AS ybar FROM {src} GROUP BY split, model),
{name} AS (
  SELECT p.split, p.model, sqrt(avg({e} * {e})) AS rmse, avg(abs({e})) AS mae,
         1 - sum({e} * {e}) / sum((p.actual - m.ybar) * (p.actual - m.ybar)) AS r2
  FROM {src} p JOIN {name}_m m ON p.split = m.split AND p.model = m.model
  GROUP BY p.split, p.model
)"""


EVAL_SQL = FEATURE_FRAME_SQL + f""",
pos AS (SELECT *, row_number() OVER (ORDER BY date, store_id) - 1 AS position, count(*) OVER () AS _n FROM features),
labeled AS (
  SELECT * EXCLUDE (_n),
         CASE WHEN position < floor(_n * {_d(TRAIN_FRAC)}) THEN 'train'
              WHEN position < floor(_n * {_d(TRAIN_FRAC)}) + floor(_n * {_d(VAL_FRAC)}) THEN 'validation'
              ELSE 'test' END AS split
  FROM pos WHERE total_revenue IS NOT NULL
),
preds AS (
  SELECT date, store_id, split, 'last_value' AS model, total_revenue AS actual,
         CAST(total_revenue_lag_1 AS DOUBLE) AS prediction FROM labeled
  UNION ALL
  SELECT date, store_id, split, 'same_weekday', total_revenue, CAST(total_revenue_lag_7 AS DOUBLE) FROM labeled
  UNION ALL
  SELECT date, store_id, split, 'weekday_mean', total_revenue,
         (total_revenue_lag_7 + total_revenue_lag_14 + total_revenue_lag_21) / {_d(3.0)} FROM labeled
),
scored AS (SELECT * FROM preds WHERE split IN ('validation', 'test')),
{_metrics_sql('scored', 'naive_metrics')},
r2v AS (SELECT model, r2 FROM naive_metrics WHERE split = 'validation'),
raw_w AS (
  SELECT model, r2,
         CASE WHEN (SELECT sum(r2) FROM r2v) > 0
              THEN greatest({_d(ENSEMBLE_MIN_WEIGHT)}, r2 / (SELECT sum(r2) FROM r2v)) ELSE {_d(1.0)} END AS raw
  FROM r2v
),
weights AS (SELECT model, r2, raw / (SELECT sum(raw) FROM raw_w) AS weight FROM raw_w),
test_naive AS (SELECT * FROM preds WHERE split = 'test'),
ens AS (
  SELECT p.date, p.store_id, p.split, 'ensemble' AS model, any_value(p.actual) AS actual,
         round(sum(w.weight * p.prediction) / sum(w.weight) * 10000.0) / 10000.0 AS prediction
  FROM test_naive p JOIN weights w ON p.model = w.model WHERE w.weight > 0
  GROUP BY p.date, p.store_id, p.split
),
{_metrics_sql('ens', 'ens_metrics')},
all_metrics AS (SELECT * FROM naive_metrics UNION ALL SELECT * FROM ens_metrics),
metrics AS (
  SELECT split, model, 'rmse' AS metric, rmse AS value FROM all_metrics
  UNION ALL SELECT split, model, 'mae', mae FROM all_metrics
  UNION ALL SELECT split, model, 'r2', r2 FROM all_metrics
),
test_preds AS (SELECT * FROM test_naive UNION ALL SELECT * FROM ens),
res AS (SELECT date, store_id, model, actual, prediction, actual - prediction AS residual FROM test_preds)"""

METRIC_SPEC = "split:string, model:string, metric:string, value:double"
PRED_SPEC = "date:date, store_id:string, split:string, model:string, actual:double, prediction:double"


# --- O04 ---------------------------------------------------------------------------------------
@query("chronological_split", "date:date, store_id:string, position:bigint, split:string")
def q_chronological_split(spark, sf_dir):
    return split.chronological_split(store_daily_of(spark, sf_dir), target="total_revenue").select(
        "date", "store_id", "position", "split")


sql(
    "chronological_split",
    BASE
    + f""",
pos AS (SELECT date, store_id, total_revenue, row_number() OVER (ORDER BY date, store_id) - 1 AS position,
               count(*) OVER () AS _n FROM store_daily)
SELECT date, store_id, position,
       CASE WHEN position < floor(_n * {_d(TRAIN_FRAC)}) THEN 'train'
            WHEN position < floor(_n * {_d(TRAIN_FRAC)}) + floor(_n * {_d(VAL_FRAC)}) THEN 'validation'
            ELSE 'test' END AS split
FROM pos WHERE total_revenue IS NOT NULL""",
)


@query("split_sizes", "split:string, rows:bigint")
def q_split_sizes(spark, sf_dir):
    return split.split_sizes(labeled(spark, sf_dir))


sql("split_sizes", EVAL_SQL + "\nSELECT split, count(*) AS rows FROM labeled GROUP BY split")


# --- naive predictions, metrics, ensemble (M06–M09, O05, R07, R12, V20) -----------------------------
@query("naive_predictions", PRED_SPEC)
def q_naive_predictions(spark, sf_dir):
    return predictions(spark, sf_dir)


sql("naive_predictions", EVAL_SQL + "\nSELECT * FROM preds")


@query("model_metrics", METRIC_SPEC)
def q_model_metrics(spark, sf_dir):
    return evaluated(spark, sf_dir)[3]


sql("model_metrics", EVAL_SQL + "\nSELECT * FROM metrics")


@query("ensemble_weights", "model:string, r2:double, weight:double")
def q_ensemble_weights(spark, sf_dir):
    return evaluated(spark, sf_dir)[1]


sql("ensemble_weights", EVAL_SQL + "\nSELECT * FROM weights")


@query("ensemble_predictions", PRED_SPEC)
def q_ensemble_predictions(spark, sf_dir):
    return evaluated(spark, sf_dir)[2].where(F.col("model") == "ensemble")


sql("ensemble_predictions", EVAL_SQL + "\nSELECT * FROM ens")


@query("equal_weight_ensemble", PRED_SPEC)
def q_equal_weight_ensemble(spark, sf_dir):
    test = predictions(spark, sf_dir).where(F.col("split") == "test")
    return evaluation.ensemble_predictions(test, None, name="mean_of_models")


sql(
    "equal_weight_ensemble",
    EVAL_SQL
    + "\nSELECT date, store_id, split, 'mean_of_models' AS model, any_value(actual) AS actual, "
    "round(sum(1.0 * prediction) / sum(1.0) * 10000.0) / 10000.0 AS prediction FROM test_naive GROUP BY date, store_id, split",
)


@query("best_model", "best_model:string, best_rmse:double")
def q_best_model(spark, sf_dir):
    m = evaluated(spark, sf_dir)[3]
    return evaluation.best_model(m.where(F.col("split") == "test"))


sql(
    "best_model",
    EVAL_SQL + "\nSELECT arg_min(model, (value, model)) AS best_model, min(value) AS best_rmse "
    "FROM metrics WHERE split = 'test' AND metric = 'rmse'",
)


@query("metric_comparison", "model:string, metric:string, value:double, is_best:boolean")
def q_metric_comparison(spark, sf_dir):
    m = evaluated(spark, sf_dir)[3].where(F.col("split") == "test").drop("split")
    return evaluation.metric_comparison(m)


sql(
    "metric_comparison",
    EVAL_SQL
    + """
SELECT model, metric, value,
       row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'r2' THEN -value ELSE value END, model) = 1
         AS is_best
FROM metrics WHERE split = 'test'""",
)


@query("rmse_alerts", METRIC_SPEC)
def q_rmse_alerts(spark, sf_dir):
    return evaluation.rmse_alerts(evaluated(spark, sf_dir)[3])


sql("rmse_alerts", EVAL_SQL + f"\nSELECT * FROM metrics WHERE metric = 'rmse' AND value > {_d(RMSE_ALERT)}")


@query("pipeline_summary", "model:string, rmse:double, mae:double, r2:double, best_model:string, is_best:boolean")
def q_pipeline_summary(spark, sf_dir):
    m = evaluated(spark, sf_dir)[3].where(F.col("split") == "test").drop("split")
    return evaluation.pipeline_summary(m, evaluation.best_model(m))


sql(
    "pipeline_summary",
    EVAL_SQL
    + """,
b AS (SELECT arg_min(model, (rmse, model)) AS best_model FROM all_metrics WHERE split = 'test')
SELECT model, rmse, mae, r2, b.best_model, model = b.best_model AS is_best FROM all_metrics, b WHERE split = 'test'""",
)


# --- J03: predictions as a forecast job leaves them, joined to what came -----------------------------
@query("predictions_with_actuals", "date:date, store_id:string, model:string, prediction:double, actual:double")
def q_predictions_with_actuals(spark, sf_dir):
    preds = predictions(spark, sf_dir).where(F.col("split") == "test").select("date", "store_id", "model", "prediction")
    return diagnostics.attach_actuals(preds, store_daily_of(spark, sf_dir))


sql(
    "predictions_with_actuals",
    EVAL_SQL + "\nSELECT p.date, p.store_id, p.model, p.prediction, s.total_revenue AS actual FROM test_naive p "
    "JOIN store_daily s ON p.date = s.date AND p.store_id = s.store_id",
)


# --- diagnostics (R01–R06, R08) --------------------------------------------------------------------
def _res(spark, sf_dir):
    return diagnostics.residuals(evaluated(spark, sf_dir)[2])


@query("residuals", "date:date, store_id:string, model:string, actual:double, prediction:double, residual:double")
def q_residuals(spark, sf_dir):
    return _res(spark, sf_dir)


sql("residuals", EVAL_SQL + "\nSELECT * FROM res")


@query(
    "residual_boxplot",
    "model:string, q1:double@2, median:double@2, q3:double@2, whisker_low:double, whisker_high:double, "
    "outliers:bigint, n:bigint",
)
def q_residual_boxplot(spark, sf_dir):
    return diagnostics.residual_boxplot(_res(spark, sf_dir))


sql(
    "residual_boxplot",
    EVAL_SQL
    + f""",
q AS (SELECT model, quantile_cont(residual, 0.25) AS q1, quantile_cont(residual, 0.5) AS median,
             quantile_cont(residual, 0.75) AS q3 FROM res GROUP BY model),
fence AS (SELECT *, q1 - {_d(IQR_MULTIPLIER)} * (q3 - q1) AS lo, q3 + {_d(IQR_MULTIPLIER)} * (q3 - q1) AS hi FROM q)
SELECT r.model, fence.q1, fence.median, fence.q3,
       min(CASE WHEN residual >= lo AND residual <= hi THEN residual END) AS whisker_low,
       max(CASE WHEN residual >= lo AND residual <= hi THEN residual END) AS whisker_high,
       count_if(NOT (residual >= lo AND residual <= hi)) AS outliers, count(*) AS n
FROM res r JOIN fence ON r.model = fence.model GROUP BY r.model, fence.q1, fence.median, fence.q3""",
)


@query("residuals_over_time", "date:date, model:string, mean_residual:double, n:bigint")
def q_residuals_over_time(spark, sf_dir):
    return diagnostics.residuals_over_time(_res(spark, sf_dir))


sql(
    "residuals_over_time",
    EVAL_SQL + "\nSELECT date, model, round(sum(residual) * 10000.0) / 10000.0 / count(*) AS mean_residual, "
    "count(*) AS n FROM res GROUP BY date, model",
)


@query("qq_points", "model:string, i:int, residual:double, theoretical:double")
def q_qq_points(spark, sf_dir):
    return diagnostics.qq_points(_res(spark, sf_dir))


def _qq_sql() -> str:
    pos = (
        "CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n) WHEN i = 1 THEN 1.0::DOUBLE - pow(0.5::DOUBLE, 1.0::DOUBLE / n) "
        f"ELSE (i - {_d(0.3175)}) / (n + {_d(0.365)}) END"
    )
    return EVAL_SQL + f""",
ranked AS (
  SELECT model, residual,
         CAST(row_number() OVER (PARTITION BY model ORDER BY residual, date, store_id) AS DOUBLE) AS i,
         CAST(count(*) OVER (PARTITION BY model) AS DOUBLE) AS n
  FROM res
),
pp AS (SELECT model, residual, i, {pos} AS p FROM ranked)
SELECT model, CAST(i AS INTEGER) AS i, residual, {normal_ppf_sql('p')} AS theoretical FROM pp"""


sql("qq_points", _qq_sql())


@query(
    "error_histogram",
    "model:string, bin:int, bin_start:double, bin_end:double, count:bigint, density:double@8",
)
def q_error_histogram(spark, sf_dir):
    return diagnostics.error_histogram(_res(spark, sf_dir))


sql(
    "error_histogram",
    EVAL_SQL
    + f""",
e AS (SELECT model, abs(residual) AS err FROM res),
st AS (SELECT model, min(err) AS lo, max(err) AS hi, count(*) AS n FROM e GROUP BY model),
st2 AS (SELECT *, CASE WHEN (hi - lo) / {_d(HISTOGRAM_BINS)} > 0 THEN (hi - lo) / {_d(HISTOGRAM_BINS)} ELSE {_d(1.0)} END
               AS width FROM st),
c AS (
  SELECT e.model, CAST(least(floor((e.err - st2.lo) / st2.width), {HISTOGRAM_BINS - 1}) AS INTEGER) AS bin, count(*) AS cnt
  FROM e JOIN st2 ON e.model = st2.model GROUP BY 1, 2
),
grid AS (SELECT model, lo, width, n, CAST(unnest(range(0, {HISTOGRAM_BINS})) AS INTEGER) AS bin FROM st2)
SELECT g.model, g.bin, g.lo + g.bin * g.width AS bin_start, g.lo + (g.bin + 1) * g.width AS bin_end,
       coalesce(c.cnt, 0) AS count, coalesce(c.cnt, 0) / (g.n * g.width) AS density
FROM grid g LEFT JOIN c ON g.model = c.model AND g.bin = c.bin""",
)


@query(
    "predictions_band",
    "date:date, store_id:string, model:string, actual:double, prediction:double, lower_bound:double, upper_bound:double",
)
def q_predictions_band(spark, sf_dir):
    test = evaluated(spark, sf_dir)[2]
    return diagnostics.predictions_with_band(test).drop("split")


sql(
    "predictions_band",
    EVAL_SQL
    + f"\nSELECT date, store_id, model, actual, prediction, prediction * {_d(1 - FORECAST_BAND)} AS lower_bound, "
    f"prediction * {_d(1 + FORECAST_BAND)} AS upper_bound FROM test_preds",
)


# --- M12: backtest with a moving origin -------------------------------------------------------------
FOLDS = 5


@query("backtest_metrics", "fold:int, model:string, metric:string, value:double@2")
def q_backtest_metrics(spark, sf_dir):
    days = materialize(store_daily_of(spark, sf_dir).select("date", "store_id", "total_revenue"))
    return backtest.fold_metrics(backtest.rolling_origin(days, FOLDS))


sql(
    "backtest_metrics",
    BASE
    + f""",
days AS (SELECT date, ntile({FOLDS + 1}) OVER (ORDER BY date) AS b FROM (SELECT DISTINCT date FROM store_daily WHERE date IS NOT NULL)),
d AS (SELECT s.date, s.store_id, CAST(s.total_revenue AS DOUBLE) AS y, days.b, isodow(s.date) AS wd
      FROM store_daily s JOIN days ON s.date = days.date WHERE s.total_revenue IS NOT NULL),
tr AS (SELECT f.fold, d.* FROM (SELECT unnest(range(1, {FOLDS + 1})) AS fold) f JOIN d ON d.b <= f.fold),
h AS (SELECT fold, store_id, arg_max(y, (date, y)) AS last_value, avg(y) AS series_mean FROM tr GROUP BY fold, store_id),
w AS (SELECT fold, store_id, wd, avg(y) AS weekday_mean FROM tr GROUP BY fold, store_id, wd),
v AS (SELECT d.b - 1 AS fold, d.y, h.last_value, h.series_mean, w.weekday_mean
      FROM d LEFT JOIN h ON h.fold = d.b - 1 AND h.store_id = d.store_id
             LEFT JOIN w ON w.fold = d.b - 1 AND w.store_id = d.store_id AND w.wd = d.wd WHERE d.b > 1),
p AS (SELECT fold, 'last_value' AS model, y, last_value AS x FROM v UNION ALL SELECT fold, 'series_mean', y, series_mean FROM v
      UNION ALL SELECT fold, 'weekday_mean', y, weekday_mean FROM v),
m AS (SELECT fold, model, sqrt(avg((y - x) * (y - x))) AS rmse, avg(abs(y - x)) AS mae,
             1 - sum((y - x) * (y - x)) / (var_pop(y) * count(*)) AS r2 FROM p WHERE x IS NOT NULL GROUP BY fold, model)
SELECT fold, model, 'rmse' AS metric, rmse AS value FROM m UNION ALL SELECT fold, model, 'mae', mae FROM m
UNION ALL SELECT fold, model, 'r2', r2 FROM m""",
)


# --- T05: interval levels ----------------------------------------------------------------------------
@query("interval_coverage", "model:string, level:int, rows:bigint, covered:bigint, mean_width:double@2")
def q_interval_coverage(spark, sf_dir):
    """Widths from the validation rows of every store and model, tried on the test rows."""
    preds = materialize(predictions(spark, sf_dir).where(
        "split IN ('validation', 'test') AND actual IS NOT NULL AND prediction IS NOT NULL"))
    held = diagnostics.residuals(preds.where("split = 'validation'"))
    out = forecast.with_intervals(preds.where("split = 'test'"), held, col="prediction")
    levels = [F.struct(F.lit(round(lv * 100)).alias("level"), F.col(f"lower_{round(lv * 100)}").alias("lo"),
                       F.col(f"upper_{round(lv * 100)}").alias("hi")) for lv in CONFIDENCE_LEVELS]
    long = out.select("model", "actual", F.explode(F.array(*levels)).alias("i")).select("model", "actual", "i.*")
    return long.groupBy("model", "level").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("actual").between(F.col("lo"), F.col("hi"))).alias("covered"),
        (F.avg(F.col("hi") - F.col("lo")) / 2).alias("mean_width"))


def _coverage_sql() -> str:
    def rank(n: str, lv: float) -> str:
        return f"ceil(({n} + 1) * {_d(lv)} - {_d(1e-9)})"

    own = ", ".join(f"min(CASE WHEN k >= {rank('n', lv)} THEN a END) AS w{round(lv * 100)}" for lv in CONFIDENCE_LEVELS)
    pool = ", ".join(f"min(CASE WHEN kp >= {rank('np', lv)} THEN a END) AS w{round(lv * 100)}" for lv in CONFIDENCE_LEVELS)
    parts = "\nUNION ALL ".join(
        f"SELECT t.model, {round(lv * 100)} AS level, t.actual, t.prediction, coalesce(o.w{round(lv * 100)}, q.w{round(lv * 100)}) AS w "
        "FROM t LEFT JOIN own o ON o.model = t.model AND o.store_id = t.store_id LEFT JOIN pool q ON q.model = t.model"
        for lv in CONFIDENCE_LEVELS)
    return EVAL_SQL + f""",
known AS (SELECT * FROM preds WHERE actual IS NOT NULL AND prediction IS NOT NULL),
cal AS (SELECT model, store_id, abs(actual - prediction) AS a FROM known WHERE split = 'validation'),
r AS (SELECT *, row_number() OVER (PARTITION BY model, store_id ORDER BY a) AS k, count(*) OVER (PARTITION BY model, store_id) AS n,
             row_number() OVER (PARTITION BY model ORDER BY a) AS kp, count(*) OVER (PARTITION BY model) AS np FROM cal),
own AS (SELECT model, store_id, {own} FROM r GROUP BY model, store_id),
pool AS (SELECT model, {pool} FROM r GROUP BY model),
t AS (SELECT * FROM known WHERE split = 'test'),
x AS ({parts})
SELECT model, level, count(*) AS rows, count_if(actual BETWEEN prediction - w AND prediction + w) AS covered,
       avg((prediction + w) - (prediction - w)) / 2 AS mean_width
FROM x GROUP BY model, level"""


sql("interval_coverage", _coverage_sql())


# --- drift (V17, V19) ------------------------------------------------------------------------------
@query("distribution_shift", "column:string, train_mean:double@2, train_std:double@2, current_mean:double@2, shifted:boolean")
def q_distribution_shift(spark, sf_dir):
    lab = labeled(spark, sf_dir)
    train = quality.profile_stats(lab.where(F.col("split") == "train"), DRIFT_COLS)
    current = lab.where(F.col("split") == "test").select(*DRIFT_COLS)
    return quality.distribution_shift(train, current)


def _shift_sql() -> str:
    parts = []
    for c in DRIFT_COLS:
        parts.append(
            f"SELECT '{c}' AS \"column\", (SELECT avg({c}) FROM labeled WHERE split = 'train') AS train_mean, "
            f"(SELECT stddev_samp({c}) FROM labeled WHERE split = 'train') AS train_std, "
            f"(SELECT avg({c}) FROM labeled WHERE split = 'test') AS current_mean"
        )
    return EVAL_SQL + ",\ns AS (" + "\nUNION ALL ".join(parts) + ")\n" + (
        "SELECT \"column\", train_mean, train_std, current_mean, "
        "abs(current_mean - train_mean) > 3.0 * train_std AS shifted FROM s"
    )


sql("distribution_shift", _shift_sql())


@query("ks_drift", "column:string, ks:double, drift:boolean")
def q_ks_drift(spark, sf_dir):
    sides = labeled(spark, sf_dir).select("split", *DRIFT_COLS)
    out = ordered.ks_statistics(sides, F.col("split") == "train", F.col("split") == "test", DRIFT_COLS)
    return out.withColumn("drift", F.col("ks") > KS_THRESHOLD)


def _ks_sql() -> str:
    ctes, parts = [], []
    for c in DRIFT_COLS:
        ctes.append(f"""{c}_j AS (
  SELECT coalesce(a.v, b.v) AS v, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM
    (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS n FROM labeled WHERE split = 'train' AND {c} IS NOT NULL GROUP BY 1) a
    FULL JOIN
    (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS n FROM labeled WHERE split = 'test' AND {c} IS NOT NULL GROUP BY 1) b
    ON a.v = b.v
),
{c}_c AS (SELECT sum(na) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS ca,
                 sum(nb) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS cb FROM {c}_j)""")
        parts.append(
            f"SELECT '{c}' AS \"column\", max(abs(ca / (SELECT sum(na) FROM {c}_j) - cb / (SELECT sum(nb) FROM {c}_j))) AS ks "
            f"FROM {c}_c"
        )
    return EVAL_SQL + ",\n" + ",\n".join(ctes) + ",\nk AS (" + "\nUNION ALL ".join(parts) + ")\n" + (
        f"SELECT \"column\", ks, ks > {_d(KS_THRESHOLD)} AS drift FROM k"
    )


sql("ks_drift", _ks_sql())
