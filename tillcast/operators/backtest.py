"""Rolling-origin backtest of the baseline forecasters: every fold in one plan, with the fold as a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators.evaluation import regression_metrics


def rolling_origin(df: DataFrame, folds: int = 5, target: str = "total_revenue", date_col: str = "date",
                   keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Long predictions ``fold, date, keys…, model, horizon, actual, prediction`` of each fold's validation block.

    The distinct days are cut into ``folds + 1`` blocks; fold k knows blocks 1
    to k and forecasts block k + 1 (the folds of ``split.time_series_folds``).
    ``last_value`` repeats the series' last known value, ``weekday_mean`` its
    mean on that weekday, ``series_mean`` its mean; ``horizon`` counts the days
    after the fold's last known one.  A series that a fold does not know has
    NULL predictions.  Rows without a date or target take no part; of several
    rows of a series on its last day the largest value counts.

    The rows are reduced to sums per series, block and weekday, and only those
    are repeated for the folds: each row is read once for the history and once
    as the one fold's truth.
    """
    if folds < 1:
        raise ValueError("folds must be at least 1")
    keys = list(keys)
    # one row per calendar day
    days = df.select(date_col).where(F.col(date_col).isNotNull()).distinct().select(
        date_col, F.ntile(folds + 1).over(Window.orderBy(date_col)).alias("_block"))
    known = df.where(F.col(target).isNotNull()).join(days, date_col).select(
        date_col, *keys, F.col(target).cast("double").alias("_y"), "_block", F.weekday(date_col).alias("_weekday"))
    last = F.max(F.struct(date_col, "_y"))
    parts = known.where(F.col("_block") <= folds).groupBy(*keys, "_block", "_weekday").agg(
        F.sum("_y").alias("_s"), F.count(F.lit(1)).alias("_n"), last.alias("_last"))
    parts = parts.withColumn("fold", F.explode(F.sequence("_block", F.lit(folds))))
    history = parts.groupBy("fold", *keys).agg(
        F.max("_last")["_y"].alias("last_value"), (F.sum("_s") / F.sum("_n")).alias("series_mean"))
    weekdays = parts.groupBy("fold", *keys, "_weekday").agg((F.sum("_s") / F.sum("_n")).alias("weekday_mean"))
    ends = days.groupBy(F.col("_block").cast("int").alias("fold")).agg(F.max(date_col).alias("_end"))
    truth = known.where(F.col("_block") > 1).withColumn("fold", (F.col("_block") - 1).cast("int"))
    out = (_matched(_matched(truth, history, ["fold", *keys]), weekdays, ["fold", *keys, "_weekday"]).join(ends, "fold"))
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("prediction"))
                       for m in ("last_value", "series_mean", "weekday_mean")])
    return out.select("fold", date_col, *keys, F.datediff(date_col, "_end").alias("horizon"), F.col("_y").alias("actual"),
                      F.explode(models).alias("_p")).select(
        "fold", date_col, *keys, "_p.model", "horizon", "actual", "_p.prediction")


def _matched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join that matches NULL keys."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(other, cond, "left").drop(*[f"_r_{c}" for c in on])


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """``fold, model, metric, value``: RMSE, MAE and R² of each fold, over the rows with a prediction."""
    return regression_metrics(predictions.where(F.col("prediction").isNotNull()), ["fold", "model"])
