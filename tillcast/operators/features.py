"""Time-series features over shared windows.

All lag and rolling expressions of one series key use the same
``Window.partitionBy(group).orderBy(date)`` spec and are added in a single
``select``; Catalyst then plans one Exchange + one Sort for all of them.

Where a series is longer than a block, the same expressions run in blocks of
rows with a halo (``series.windowed``), so neither a hot series nor a table
without a series key becomes one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import EWM_SPANS, LAGS, RATIO_WINDOWS, ROLLING_FUNCS, ROLLING_WINDOWS, FeatureConfig
from tillcast.functions import dates
from tillcast.operators import series


def series_window(group_cols: Sequence[str], date_col: str = "date"):
    w = Window.orderBy(date_col)
    return Window.partitionBy(*group_cols).orderBy(date_col) if group_cols else w


def lag_columns(target: str, w, lags: Sequence[int] = LAGS) -> list[Column]:
    """``{target}_lag_{k}`` (row based; missing days are not filled)."""
    return [F.lag(target, k).over(w).alias(f"{target}_lag_{k}") for k in lags]


def _rolling(func: str, x: Column, frame) -> Column:
    if func == "mean":
        return F.avg(x).over(frame)
    if func == "std":
        return F.stddev_samp(x).over(frame)
    if func == "min":
        return F.min(x).over(frame)
    if func == "max":
        return F.max(x).over(frame)
    if func == "median":
        return F.percentile(x, 0.5).over(frame)
    raise ValueError(f"unknown rolling function {func}")


def rolling_columns(
    target: str,
    w,
    windows: Sequence[int] = ROLLING_WINDOWS,
    funcs: Sequence[str] = ROLLING_FUNCS,
    min_periods: int | None = 1,
    shift: int = 0,
) -> list[Column]:
    """``{target}_rolling_{k}_{func}`` over the last k rows.

    ``min_periods=None`` requires a full window (``k`` non-null rows);
    ``shift=1`` ends the frame at the previous row (no target leakage).
    """
    x = F.col(target)
    out = []
    for k in windows:
        frame = w.rowsBetween(-(k - 1) - shift, -shift)
        need = k if min_periods is None else min_periods
        n = F.count(x).over(frame)
        for func in funcs:
            val = _rolling(func, x, frame)
            if need > 1:
                val = F.when(n >= need, val)
            out.append(val.alias(f"{target}_rolling_{k}_{func}"))
    return out


def with_ewm(df: DataFrame, target: str, spans: Sequence[int] = EWM_SPANS, group_cols: Sequence[str] = ("store_id",),
             date_col: str = "date") -> DataFrame:
    """``{target}_ewm_{span}``, exponentially weighted means with the whole history (``adjust=False``).

    NULLs and rows of equal date: see :func:`series.ewm`, which scans affine
    maps in blocks, so a hot or unkeyed series is spread over many tasks.
    """
    return series.ewm(df, target, spans, list(group_cols), [date_col])


def time_series_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), block_rows: int = series.BLOCK_ROWS) -> DataFrame:
    """Calendar + lag + rolling + cyclical features; series of any length (see :func:`series.windowed`)."""
    base = [c for c in df.columns if c not in ("is_holiday",)]

    def build(w, _place: Column) -> list[Column]:
        return [
            *lag_columns(cfg.target, w, cfg.lags),
            *rolling_columns(cfg.target, w, cfg.windows, cfg.funcs, cfg.min_periods, cfg.shift),
        ]

    halo = max([*cfg.lags, *(k - 1 + cfg.shift for k in cfg.windows)], default=0)
    done = series.windowed(df, list(cfg.group_cols), [cfg.date_col], build, halo, block_rows)
    made = [c for c in done.columns if c not in df.columns]
    return done.select(*base, *dates.date_feature_columns(cfg.date_col), *made, *dates.cyclical_columns(cfg.date_col))


def advanced_columns(target: str, w, date_col: str = "date", has_discount: str | None = "has_discount") -> list[Column]:
    """W10–W13, D12–D15 (trend, velocity, ratios and month positions).

    Velocity, acceleration and ratios are computed per series (the ungrouped
    original lets them run across series boundaries).
    """
    t = F.col(target)
    lag1, lag2 = F.lag(t, 1).over(w), F.lag(t, 2).over(w)
    trend = F.row_number().over(w) - 1
    cols = [
        trend.alias("trend"),
        (trend * trend).alias("trend_squared"),
        (t - lag1).alias(f"{target}_velocity"),
        ((t - lag1) - (lag1 - lag2)).alias(f"{target}_acceleration"),
    ]
    for k in RATIO_WINDOWS:
        ratio = t / (F.avg(t).over(w.rowsBetween(-(k - 1), 0)) + 1)
        cols += [ratio.alias(f"{target}_ratio_to_{k}d_avg"), ratio.alias(f"{target}_ratio_to_{k}d")]
    cols += dates.month_position_columns(date_col)
    if has_discount:
        cols.append(dates.promotion_weekend(has_discount, date_col))
    return cols


def interaction_columns(categorical_cols: Sequence[str]) -> list[Column]:
    """``a_b_interaction`` = a + "_" + b for every pair of categorical columns (a NULL part is written ``nan``)."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("nan"))

    out = []
    for i, a in enumerate(categorical_cols):
        for b in categorical_cols[i + 1:]:
            out.append(
                F.concat(shown(a), F.lit("_"), shown(b)).alias(f"{a}_{b}_interaction")
            )
    return out


# ---------------------------------------------------------------------------
# null handling
# ---------------------------------------------------------------------------
def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL → column mean; all means come from one scalar-subquery aggregate."""
    if not cols:
        return df
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("m")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), means.getField(c)) for c in cols})


def fill_forward_backward(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str],
                          date_col: str = "date", scope: str = "global") -> DataFrame:
    """Forward fill then backward fill in (group, date) order.

    ``scope="group"`` fills inside each series only.  ``scope="global"``
    reproduces a fill over the whole sorted table, where a series' leading
    NULLs take the previous series' last value: per-series windows do the
    inside part, and a one-row-per-series boundary table (last / first
    non-null value) carries values across series in group-key order.
    The backward part runs forward over the reversed rows: a frame that ends
    at the last row would be read again for every row.
    """
    if not cols:
        return df
    w = Window.partitionBy(*group_cols).orderBy(date_col)
    placed = df.withColumn("_place", F.row_number().over(w))
    fwd = w.rowsBetween(Window.unboundedPreceding, 0)
    bwd = Window.partitionBy(*group_cols).orderBy(F.desc("_place")).rowsBetween(Window.unboundedPreceding, 0)
    inner = {c: (F.last(c, True).over(fwd), F.last(c, True).over(bwd)) for c in cols}
    if scope == "group":
        return placed.withColumns({c: F.coalesce(F.col(c), f, b) for c, (f, b) in inner.items()}).drop("_place")
    if scope != "global":
        raise ValueError(scope)

    d = F.col(date_col)
    bounds = df.groupBy(*group_cols).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), d)).alias(f"_last_{c}") for c in cols],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), d)).alias(f"_first_{c}") for c in cols],
    )
    # one row per series; ordering the series keys is a small single-partition window
    gw, back = Window.orderBy(*group_cols), Window.orderBy(*[F.desc(g) for g in group_cols])
    carry = bounds.select(
        *group_cols,
        *[F.last(f"_last_{c}", True).over(gw.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_in_{c}")
          for c in cols],
        *[F.last(f"_first_{c}", True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_back_{c}")
          for c in cols],
    )
    out = placed.join(carry, list(group_cols), "left")
    out = out.withColumns(
        {c: F.coalesce(F.col(c), f, F.col(f"_in_{c}"), b, F.col(f"_back_{c}")) for c, (f, b) in inner.items()}
    )
    return out.drop(*[f"_in_{c}" for c in cols], *[f"_back_{c}" for c in cols]).select(*df.columns)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by schema type."""
    num = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [n for n, t in df.dtypes if t in num or t.startswith("decimal")]


def handle_missing_values(df: DataFrame, group_cols: Sequence[str], target: str | None = None,
                          date_col: str = "date", scope: str = "global", only_with_nulls: bool = False) -> DataFrame:
    """Lag/rolling columns: ffill→bfill; other numeric columns: column mean.

    The target is excluded from mean imputation (rows without a target are
    dropped later instead).  ``only_with_nulls`` first counts NULLs per column
    in one aggregate (use it on a materialized frame) and skips clean columns.
    """
    num = [c for c in numeric_columns(df) if c not in group_cols]
    if only_with_nulls and num:
        # one-row aggregate (bounded): fill only columns that contain NULLs
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in num]).first().asDict()
        num = [c for c in num if counts[c] > 0]
    moving = [c for c in num if "_lag_" in c or "_rolling_" in c]
    other = [c for c in num if c not in moving and c != target]
    out = fill_forward_backward(df, moving, group_cols, date_col, scope)
    return fill_mean(out, other)


def feature_table(store_daily: DataFrame, cfg: FeatureConfig = FeatureConfig(), scope: str = "global",
                  materialize: bool = True) -> DataFrame:
    """The training feature frame: 53 columns (51 model features + date + target).

    The windowed frame is read by three passes (series boundaries, column
    means, the fill itself); it is checkpointed once so the upstream scans,
    joins and windows run a single time.
    """
    feats = time_series_features(store_daily, cfg)
    if materialize:
        from tillcast.session import materialize as _checkpoint

        feats = _checkpoint(feats)
    return handle_missing_values(feats, cfg.group_cols, cfg.target, cfg.date_col, scope, only_with_nulls=materialize)


def single_series_features(history: DataFrame, target: str = "total_revenue", date_col: str = "date",
                           group_cols: Sequence[str] = ("store_id",)) -> DataFrame:
    """Forecast-input features of day-grain series (one per ``group_cols`` key).

    Lags and full-window rolling statistics; NULL std → 0, other NULL
    lag/rolling values → the mean of all history; calendar and cyclical parts.
    """
    w = series_window([g for g in group_cols if g in history.columns], date_col)
    cal = dates.date_feature_columns(date_col, ("year", "month", "day", "dayofweek", "quarter", "weekofyear", "is_weekend"))
    feats = history.select(
        *history.columns, *cal, *dates.cyclical_columns(date_col),
        *lag_columns(target, w), *rolling_columns(target, w, min_periods=None),
    )
    mean = history.agg(F.avg(target)).scalar()
    generated = [c for c in feats.columns if c.startswith(f"{target}_lag") or c.startswith(f"{target}_rolling")]
    return feats.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0.0) if c.endswith("_std") else mean) for c in generated}
    )
