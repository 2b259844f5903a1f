"""Model diagnostics: the tables behind residual, Q-Q, error and importance charts.

All inputs are long prediction tables ``(keys…, model, actual, prediction)``
joined on the full key (date, store) — never on date alone, which would fan
out across stores.  Per-model statistics (quartiles, min/max) are one-row-per
-model tables joined back by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import FORECAST_BAND, HISTOGRAM_BINS, IQR_MULTIPLIER, TOP_FEATURES
from tillcast.functions.stats import filliben_position, normal_ppf
from tillcast.operators.ordered import grouped_quantiles, ranks

KEYS = ("date", "store_id")


def attach_actuals(predictions: DataFrame, actuals: DataFrame, target: str = "total_revenue",
                   keys: Sequence[str] = KEYS) -> DataFrame:
    """Inner join of predictions to actuals on the full key."""
    a = actuals.select(*keys, F.col(target).alias("actual"))
    return predictions.join(a, list(keys), "inner")


def residuals(preds: DataFrame) -> DataFrame:
    """residual = actual − prediction, next to the prediction."""
    return preds.withColumn("residual", F.col("actual") - F.col("prediction"))


def residual_boxplot(res: DataFrame) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers and outlier count per model."""
    q = grouped_quantiles(res, ["model"], "residual", [0.25, 0.5, 0.75])
    q = q.withColumnsRenamed({"q_0": "q1", "q_1": "median", "q_2": "q3"})
    q = q.withColumn("lo_fence", F.col("q1") - IQR_MULTIPLIER * (F.col("q3") - F.col("q1"))).withColumn(
        "hi_fence", F.col("q3") + IQR_MULTIPLIER * (F.col("q3") - F.col("q1"))
    )
    r = F.col("residual")
    inside = (r >= F.col("lo_fence")) & (r <= F.col("hi_fence"))
    return res.join(q, "model").groupBy("model", "q1", "median", "q3").agg(
        F.min(F.when(inside, r)).alias("whisker_low"),
        F.max(F.when(inside, r)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def residuals_over_time(res: DataFrame) -> DataFrame:
    """Mean residual per (date, model).

    The residual sum is snapped to 1e-4 money units before dividing, so the
    mean does not depend on the order in which partial sums merge.
    """
    from tillcast.operators.cleaning import round_money

    agg = res.groupBy("date", "model").agg(round_money(F.sum("residual")).alias("_s"), F.count(F.lit(1)).alias("n"))
    return agg.select("date", "model", (F.col("_s") / F.col("n")).alias("mean_residual"), "n")


def qq_points(res: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Normal probability-plot points per model (ordered residual vs Φ⁻¹ of Filliben medians).

    Ranks come from value ranges, so a model's residuals are never sorted in one task.
    """
    ranked = ranks(res.select("model", "residual", *keys), ["model"], "residual", keys)
    return ranked.select(
        "model", F.col("rank").cast("int").alias("i"), "residual",
        normal_ppf(filliben_position(F.col("rank").cast("double"), F.col("n").cast("double"))).alias("theoretical"),
    )


def error_histogram(res: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Absolute-error histogram with ``bins`` equal bins per model, as densities.

    Every bin appears (empty bins with count 0); the maximum falls into the
    last bin; density = count / (n · width), so it integrates to 1.
    """
    e = res.select("model", F.abs("residual").alias("err"))
    stats = e.groupBy("model").agg(F.min("err").alias("lo"), F.max("err").alias("hi"), F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    stats = stats.withColumn("width", F.when(width > 0, width).otherwise(F.lit(1.0)))
    idx = F.least(F.floor((F.col("err") - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("int")
    counts = e.join(stats, "model").groupBy("model", idx.alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    grid = stats.select("model", "lo", "width", "n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, ["model", "bin"], "left").fillna(0, ["count"])
    return out.select(
        "model", "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        "count",
        (F.col("count") / (F.col("n") * F.col("width"))).alias("density"),
    )


def predictions_with_band(preds: DataFrame, band: float = FORECAST_BAND) -> DataFrame:
    """Prediction with a ±band envelope (not a statistical interval)."""
    p = F.col("prediction")
    return preds.withColumn("lower_bound", p * (1 - band)).withColumn("upper_bound", p * (1 + band))


def top_features(importance: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """The ``n`` most important features per model."""
    w = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return importance.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
