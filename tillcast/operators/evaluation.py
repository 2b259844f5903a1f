"""Predictions, metrics, ensemble weighting and model selection (long format).

Predictions are a long table ``(keys…, model, actual, prediction)``; every
model-level result is a grouped aggregate over it, so any number of models
and stores is handled by one plan.  Per-model tables (one row per model) are
the only ones broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import ENSEMBLE_MIN_WEIGHT, RMSE_ALERT

KEYS = ("date", "store_id")


def naive_predictions(features: DataFrame, target: str = "total_revenue",
                      models: Mapping[str, F.Column] | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Baseline forecasters from lag features, as a long prediction table.

    ``last_value`` = lag 1, ``same_weekday`` = lag 7, ``weekday_mean`` = mean of
    lags 7/14/21.  They make the metric and ensemble operators checkable
    before any model is trained.
    """
    t = target
    models = models or {
        "last_value": F.col(f"{t}_lag_1"),
        "same_weekday": F.col(f"{t}_lag_7"),
        "weekday_mean": (F.col(f"{t}_lag_7") + F.col(f"{t}_lag_14") + F.col(f"{t}_lag_21")) / 3.0,
    }
    extra = [c for c in ("split",) if c in features.columns]
    # one scan for all models
    pairs = F.array(*[F.struct(F.lit(name).alias("model"), expr.cast("double").alias("prediction")) for name, expr in models.items()])
    rows = features.select(*keys, *extra, F.col(t).alias("actual"), F.explode(pairs).alias("_p"))
    return rows.select(*keys, *extra, "_p.model", "actual", "_p.prediction")


def regression_metrics(preds: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """RMSE, MAE and R² per group, long form ``(by…, metric, value)``, in one pass.

    R² of a constant actual is 1 for exact predictions and 0 otherwise.
    """
    by = list(by)
    e = F.col("actual") - F.col("prediction")
    sse = F.sum(e * e)
    both = F.when(F.col("prediction").isNotNull(), F.col("actual"))
    sst = F.var_pop(both) * F.count(both)
    agg = preds.groupBy(*by).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.when(sst > 0, 1 - F.try_divide(sse, sst)).when(sse.isNotNull(), F.when(sse == 0, 1.0).otherwise(0.0)).alias("r2"),
    )
    return agg.select(*by, F.expr("stack(3, 'rmse', rmse, 'mae', mae, 'r2', r2) AS (metric, value)"))


def ensemble_weights(val_metrics: DataFrame, min_weight: float = ENSEMBLE_MIN_WEIGHT) -> DataFrame:
    """w_i = max(min_weight, r2_i / Σr2), renormalised to sum 1.

    A non-positive Σr2 gives equal weights.
    """
    r2 = val_metrics.where(F.col("metric") == "r2").select("model", F.col("value").alias("r2"))
    total = r2.agg(F.sum("r2")).scalar()
    raw = F.when(total > 0, F.greatest(F.lit(min_weight), F.col("r2") / total)).otherwise(F.lit(1.0))
    w = r2.withColumn("_raw", raw)
    return w.select("model", "r2", (F.col("_raw") / w.agg(F.sum("_raw")).scalar()).alias("weight"))


def ensemble_predictions(preds: DataFrame, weights: DataFrame | None = None, name: str = "ensemble",
                         keys: Sequence[str] = KEYS) -> DataFrame:
    """Σ w·pred / Σ w per key (zero weights skipped); equal weights without ``weights``.

    The blend is snapped to 1e-4 money units, so it does not depend on the
    order in which the per-model rows are summed.
    """
    from tillcast.operators.cleaning import round_money

    keys = list(keys)
    extra = [c for c in ("split",) if c in preds.columns]
    if weights is None:
        p = preds.withColumn("weight", F.lit(1.0))
    else:
        p = preds.join(F.broadcast(weights.select("model", "weight")), "model").where(F.col("weight") > 0)
    return p.groupBy(*keys, *extra).agg(
        F.first("actual").alias("actual"),
        round_money(F.sum(F.col("weight") * F.col("prediction")) / F.sum("weight")).alias("prediction"),
    ).select(*keys, *extra, F.lit(name).alias("model"), "actual", "prediction")


def best_model(metrics: DataFrame, metric: str = "rmse") -> DataFrame:
    """Model with the lowest value of ``metric`` (ties → smallest name)."""
    m = metrics.where(F.col("metric") == metric)
    return m.agg(F.min_by("model", F.struct("value", "model")).alias("best_model"),
                 F.min("value").alias(f"best_{metric}"))


def metric_comparison(metrics: DataFrame) -> DataFrame:
    """Every (model, metric) with a flag for the best (min RMSE/MAE, max R²)."""
    better = F.when(F.col("metric") == "r2", -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy("metric").orderBy(better, "model")
    return metrics.withColumn("is_best", F.row_number().over(w) == 1)


def rmse_alerts(metrics: DataFrame, threshold: float = RMSE_ALERT) -> DataFrame:
    """V20."""
    return metrics.where((F.col("metric") == "rmse") & (F.col("value") > threshold))


def metrics_wide(metrics: DataFrame) -> DataFrame:
    """R11 inverse: one row with ``{model}_{metric}`` columns (run-log layout)."""
    return metrics.select(F.concat_ws("_", "model", "metric").alias("key"), "value").groupBy().pivot("key").agg(
        F.first("value")
    )


def metrics_long(wide: DataFrame) -> DataFrame:
    """``{model}_{metric}`` columns back to (model, metric, value)."""
    cols = [c for c in wide.columns if "_" in c]
    long = wide.unpivot([], cols, "key", "value")
    parts = F.split("key", "_")
    return long.select(
        F.array_join(F.slice(parts, 1, F.size(parts) - 1), "_").alias("model"),
        F.element_at(parts, -1).alias("metric"),
        "value",
    )


def pipeline_summary(metrics: DataFrame, best: DataFrame) -> DataFrame:
    """The test metrics of every model next to the chosen best model."""
    wide = metrics.groupBy("model").pivot("metric", ["rmse", "mae", "r2"]).agg(F.first("value"))
    chosen = best.select("best_model").scalar()
    return wide.withColumn("best_model", chosen).withColumn("is_best", F.col("model") == chosen)
