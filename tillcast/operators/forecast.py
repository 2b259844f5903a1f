"""Forecast frames for every store at once.

The history of each store is reduced to one row of tail statistics (last-k
lags and rolling statistics of the most recent 30 rows, plus the series
mean), a day spine of ``horizon`` dates is generated after the store's last
date, and the constant statistics are attached to every future day — the
horizon is not forecast recursively.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import (
    CONFIDENCE_LEVELS, FALLBACK_FEATURES, FORECAST_BAND, FORECAST_HORIZON, HISTORY_TAIL, LAGS,
    MISSING_COLUMN_DEFAULTS, ROLLING_WINDOWS,
)
from tillcast.functions import dates
from tillcast.operators.ordered import grouped_quantiles, running_totals


def tail_statistics(history: DataFrame, target: str = "total_revenue", date_col: str = "date",
                    group_cols: Sequence[str] = ("store_id",), tail: int = HISTORY_TAIL) -> DataFrame:
    """Per series, last date, lags 1…30 and rolling stats of the last 30 rows.

    A lag k uses the k-th most recent value when the tail holds ≥ k rows,
    else the mean of the whole history; a window k uses the last k values
    (population std) when available, else mean / 0 / mean / mean / mean.
    """
    g = list(group_cols)
    t = F.col(target)
    rn = F.row_number().over(Window.partitionBy(*g).orderBy(F.col(date_col).desc()))
    h = history.select(*g, date_col, target, rn.alias("_rn"))
    n_tail = F.count(F.when(F.col("_rn") <= tail, t))
    mean = F.avg(t)
    aggs = [F.max(date_col).alias("last_date"), mean.alias("series_mean"), n_tail.alias("tail_rows")]
    for k in LAGS:
        val = F.max(F.when(F.col("_rn") == k, t))
        aggs.append(F.when(n_tail >= k, val).otherwise(mean).alias(f"{target}_lag_{k}"))
    for k in ROLLING_WINDOWS:
        x = F.when(F.col("_rn") <= k, t)
        full = n_tail >= k
        aggs += [
            F.when(full, F.avg(x)).otherwise(mean).alias(f"{target}_rolling_{k}_mean"),
            F.when(full, F.stddev_pop(x)).otherwise(F.lit(0.0)).alias(f"{target}_rolling_{k}_std"),
            F.when(full, F.min(x)).otherwise(mean).alias(f"{target}_rolling_{k}_min"),
            F.when(full, F.max(x)).otherwise(mean).alias(f"{target}_rolling_{k}_max"),
            F.when(full, F.percentile(x, 0.5)).otherwise(mean).alias(f"{target}_rolling_{k}_median"),
        ]
    return h.groupBy(*g).agg(*aggs)


def future_dates(stats: DataFrame, horizon: int = FORECAST_HORIZON,
                 group_cols: Sequence[str] = ("store_id",)) -> DataFrame:
    """``horizon`` consecutive days after each series' last date."""
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    spine = F.sequence(F.date_add("last_date", 1), F.date_add("last_date", horizon))
    return stats.select(*group_cols, F.explode(spine).alias("date"), *[c for c in stats.columns
                                                                      if c not in group_cols])


def store_number(store_id: str | Column) -> Column:
    """Digits of a ``store_XXX`` code as an integer; 1 when the code has no such form, null when they exceed an int."""
    s = F.col(store_id) if isinstance(store_id, str) else store_id
    digits = F.regexp_extract(s, r"(\d+)", 1)
    return F.when(s.contains("store_") & (digits != ""), digits.try_cast("int")).otherwise(F.lit(1))


def map_unknown(df: DataFrame, col: str, known: DataFrame) -> DataFrame:
    """Values absent from ``known`` (one column of labels) become the smallest known label."""
    first = known.agg(F.min(col)).scalar()
    k = known.select(col).distinct().withColumn("_known", F.lit(True))
    out = df.join(k, col, "left")
    return out.withColumn(col, F.when(F.col("_known"), F.col(col)).otherwise(first)).drop("_known")


def with_defaults(df: DataFrame, defaults=MISSING_COLUMN_DEFAULTS) -> DataFrame:
    """P10: constant columns for inputs the history does not carry."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def align_features(df: DataFrame, feature_cols: Sequence[str] | None) -> DataFrame:
    """Exactly the trained feature list (absent → 0.0); without one, the basic set."""
    if not feature_cols:
        feature_cols = [c for c in FALLBACK_FEATURES if c in df.columns]
        feature_cols += [c for c in df.columns if c.startswith("store_id_") and c != "store_id"]
    return df.select(*[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in feature_cols])


def forecast_frame(history: DataFrame, horizon: int = FORECAST_HORIZON, target: str = "total_revenue",
                   date_col: str = "date", group_cols: Sequence[str] = ("store_id",)) -> DataFrame:
    """T01 feature side: one row per (store, future day) with calendar, cyclical,
    constant lag/rolling features and defaults."""
    stats = tail_statistics(history, target, date_col, group_cols)
    fut = future_dates(stats, horizon, group_cols)
    cal = dates.date_feature_columns("date", ("year", "month", "day", "dayofweek", "quarter", "weekofyear",
                                              "is_weekend"))
    keep = [c for c in fut.columns if c not in ("last_date", "tail_rows")]
    out = fut.select(*keep, *cal, *dates.cyclical_columns("date"))
    return with_defaults(out)


def with_band(preds: DataFrame, band: float = FORECAST_BAND, col: str = "predicted_sales") -> DataFrame:
    """±band envelope around the prediction."""
    p = F.col(col)
    return preds.withColumn("lower_bound", p * (1 - band)).withColumn("upper_bound", p * (1 + band))


def forecast_summary(preds: DataFrame, col: str = "predicted_sales", group_cols: Sequence[str] = ("store_id",)) -> DataFrame:
    """Total, mean, max and min forecast per series."""
    p = F.col(col)
    return preds.groupBy(*group_cols).agg(
        F.sum(p).alias("total_predicted_sales"), F.avg(p).alias("average_daily_sales"),
        F.max(p).alias("max_daily_sales"), F.min(p).alias("min_daily_sales"),
    )


def history_and_forecast(history: DataFrame, preds: DataFrame, target: str = "total_revenue",
                         col: str = "predicted_sales") -> DataFrame:
    """One series table with a ``kind`` column (history / forecast)."""
    h = history.select("date", "store_id", F.col(target).alias("value"), F.lit("history").alias("kind"))
    f = preds.select("date", "store_id", F.col(col).alias("value"), F.lit("forecast").alias("kind"))
    return h.unionByName(f)


def residual_intervals(preds: DataFrame, residuals: DataFrame, levels: Sequence[float] = CONFIDENCE_LEVELS,
                       col: str = "predicted_sales", group_cols: Sequence[str] = ("store_id",)) -> DataFrame:
    """Empirical intervals — prediction + residual quantiles per series and level."""
    qs = sorted({q for lv in levels for q in ((1 - lv) / 2, (1 + lv) / 2)})
    rq = grouped_quantiles(residuals, list(group_cols), "residual", qs)
    out = preds.join(rq, list(group_cols), "left")
    cols = {}
    for lv in levels:
        lo, hi = qs.index((1 - lv) / 2), qs.index((1 + lv) / 2)
        tag = int(round(lv * 100))
        cols[f"lower_{tag}"] = F.col(col) + F.col(f"q_{lo}")
        cols[f"upper_{tag}"] = F.col(col) + F.col(f"q_{hi}")
    return out.withColumns(cols).drop(*[f"q_{i}" for i in range(len(qs))])


def _level_names(levels: Sequence[float]) -> dict[float, str]:
    return {lv: f"{lv * 100:g}".replace(".", "_") for lv in levels}


def conformal_widths(residuals: DataFrame, group_cols: Sequence[str] = ("model", "store_id"),
                     levels: Sequence[float] = CONFIDENCE_LEVELS) -> DataFrame:
    """Split-conformal half-widths from held-out ``residual``s: ``group_cols…, n, width_{level}``.

    The width of a level is the ⌈(n + 1)·level⌉-th smallest absolute residual
    of the group, which covers a new exchangeable value with at least that
    probability; it is NULL where the group is too small for the level.  NULL
    residuals take no part, equal ones count as often as they occur.  Values
    are reduced to counts and ranked over value ranges, so a group of any size
    is spread over tasks.
    """
    groups = list(group_cols)
    scores = residuals.where(F.col("residual").isNotNull()).groupBy(*groups, F.abs("residual").alias("_a")).agg(
        F.count(F.lit(1)).alias("_n"))
    n = F.col("n")
    sizes = scores.groupBy(*groups).agg(F.sum("_n").alias("n")).withColumnsRenamed({g: f"_g_{g}" for g in groups})
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups] or F.lit(True)
    ranked = running_totals(scores, "_a", ["_n"], groups).join(sizes, same).drop(*[f"_g_{g}" for g in groups])
    widths = [F.min(F.when(F.col("cum__n") >= F.ceil((n + 1) * F.lit(float(lv)) - 1e-9), F.col("_a"))).alias(f"width_{name}")
              for lv, name in _level_names(levels).items()]
    return ranked.groupBy(*groups).agg(F.first("n").alias("n"), *widths)


def with_intervals(preds: DataFrame, residuals: DataFrame, levels: Sequence[float] = CONFIDENCE_LEVELS,
                   col: str = "predicted_sales", pool_cols: Sequence[str] = ("model",),
                   series_cols: Sequence[str] = ("store_id",)) -> DataFrame:
    """``preds`` with ``lower_{level}, upper_{level}``, the prediction ± its series' conformal width.

    A series without enough residuals for a level takes the width over all
    series of its ``pool_cols``; without that either, its bounds are NULL.
    """
    groups, pool = [*pool_cols, *series_cols], list(pool_cols)
    out = preds
    for by, tag in ((groups, "s"), (pool, "p")):
        w = conformal_widths(residuals, by, levels).drop("n")
        w = w.select(*[F.col(g).alias(f"_{tag}_{g}") for g in by],
                     *[F.col(f"width_{x}").alias(f"_{tag}w_{x}") for x in _level_names(levels).values()])
        same = [F.col(g).eqNullSafe(F.col(f"_{tag}_{g}")) for g in by] or F.lit(True)
        out = out.join(w, same, "left")
    bounds = {}
    for name in _level_names(levels).values():
        width = F.coalesce(F.col(f"_sw_{name}"), F.col(f"_pw_{name}"))
        bounds |= {f"lower_{name}": F.col(col) - width, f"upper_{name}": F.col(col) + width}
    return out.select(*[F.col(f"`{c}`") for c in preds.columns], *[c.alias(x) for x, c in bounds.items()])
