"""Registered feature queries (D, W, N rows) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.config import EWM_SPANS, FeatureConfig
from tillcast.functions import dates
from tillcast.functions.holidays import holiday_calendar, holiday_name_sql, holiday_sql
from tillcast.operators import cleaning, features, series
from tillcast.plans import sqlgen as G
from tillcast.plans.oracle import BASE, DAILY, SALES, sql, with_ctes
from tillcast.plans.registry import query, store_daily_of
from tillcast.sources import tables as T

CAL_SPEC = "year:int, month:int, day:int, dayofweek:int, quarter:int, weekofyear:int, is_weekend:int, is_holiday:int"
CYC_SPEC = "month_sin:double, month_cos:double, day_sin:double, day_cos:double, dayofweek_sin:double, dayofweek_cos:double"
LAG_SPEC = ", ".join(f"{c}:double" for c in G.lag_names())
# sample std is computed by different (equally valid) recurrences in the two engines
ROLL_SPEC = ", ".join(f"{c}:double@2" if c.endswith("_std") else f"{c}:double" for c in G.rolling_names())
SD_SPEC = (
    "date:date, store_id:string, has_discount:double, total_revenue:double, quantity_sold:double, "
    "profit:double, customer_traffic:double"
)
SD_COLS = "date, store_id, has_discount, total_revenue, quantity_sold, profit, customer_traffic"


# --- D01–D11 ----------------------------------------------------------------
@query("calendar_features", f"date:date, store_id:string, {CAL_SPEC}, {CYC_SPEC}")
def q_calendar_features(spark, sf_dir):
    sd = store_daily_of(spark, sf_dir)
    return sd.select("date", "store_id", *dates.date_feature_columns("date"), *dates.cyclical_columns("date"))


sql(
    "calendar_features",
    BASE + f"\nSELECT date, store_id, {', '.join(G.date_features())}, {', '.join(G.cyclical())} FROM store_daily",
)


# --- W01 ----------------------------------------------------------------------
@query("lag_features", f"date:date, store_id:string, total_revenue:double, {LAG_SPEC}")
def q_lag_features(spark, sf_dir):
    sd = store_daily_of(spark, sf_dir)
    w = features.series_window(["store_id"])
    return sd.select("date", "store_id", "total_revenue", *features.lag_columns("total_revenue", w))


sql(
    "lag_features",
    BASE + f"\nSELECT date, store_id, total_revenue, {', '.join(G.lags('total_revenue', 'store_id'))} FROM store_daily",
)


# --- W03–W07 --------------------------------------------------------------------
@query("rolling_features", f"date:date, store_id:string, {ROLL_SPEC}")
def q_rolling_features(spark, sf_dir):
    sd = store_daily_of(spark, sf_dir)
    w = features.series_window(["store_id"])
    return sd.select("date", "store_id", *features.rolling_columns("total_revenue", w))


sql(
    "rolling_features",
    BASE + f"\nSELECT date, store_id, {', '.join(G.rolling('total_revenue', 'store_id'))} FROM store_daily",
)


# --- full training frame: D01–D11, W01, W03–W07, N02, N04 -------------------------
FEATURE_TABLE_SPEC = f"{SD_SPEC}, {CAL_SPEC}, {LAG_SPEC}, {ROLL_SPEC}, {CYC_SPEC}"


@query("feature_table", FEATURE_TABLE_SPEC)
def q_feature_table(spark, sf_dir):
    return features.feature_table(store_daily_of(spark, sf_dir), FeatureConfig())


def _feature_frame_sql() -> str:
    gen = G.lag_names() + G.rolling_names()
    order = "ORDER BY store_id, date"
    fills = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in gen
    )
    return (
        BASE
        + f""",
f AS (
  SELECT {SD_COLS}, {', '.join(G.date_features())},
         {', '.join(G.lags('total_revenue', 'store_id'))},
         {', '.join(G.rolling('total_revenue', 'store_id'))},
         {', '.join(G.cyclical())}
  FROM store_daily
),
features AS (SELECT * REPLACE ({fills}) FROM f)"""
    )


FEATURE_FRAME_SQL = _feature_frame_sql()
sql("feature_table", FEATURE_FRAME_SQL + "\nSELECT * FROM features")


# --- N03: fill inside each series only -----------------------------------------
@query("fill_within_series", f"date:date, store_id:string, {LAG_SPEC}")
def q_fill_within_series(spark, sf_dir):
    sd = store_daily_of(spark, sf_dir)
    w = features.series_window(["store_id"])
    lagged = sd.select("date", "store_id", *features.lag_columns("total_revenue", w))
    return features.fill_forward_backward(lagged, G.lag_names(), ["store_id"], scope="group")


def _fill_group_sql() -> str:
    w = "PARTITION BY store_id ORDER BY date"
    fills = ", ".join(
        f"coalesce({c}, last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in G.lag_names()
    )
    return BASE + f""",
l AS (SELECT date, store_id, {', '.join(G.lags('total_revenue', 'store_id'))} FROM store_daily)
SELECT date, store_id, {fills} FROM l"""


sql("fill_within_series", _fill_group_sql())


# --- W09–W13, D12–D15 -----------------------------------------------------------
ADV_SPEC = (
    "date:date, store_id:string, "
    + ", ".join(f"total_revenue_ewm_{s}:double" for s in EWM_SPANS)
    + ", trend:int, trend_squared:int, total_revenue_velocity:double, total_revenue_acceleration:double, "
    "total_revenue_ratio_to_7d_avg:double, total_revenue_ratio_to_7d:double, "
    "total_revenue_ratio_to_30d_avg:double, total_revenue_ratio_to_30d:double, "
    "day_of_month:int, is_month_start:int, is_month_end:int, week_of_month:int, quarter_progress:int, "
    "is_quarter_end:int, days_since_month_start:int, promotion_weekend:double"
)


@query("advanced_features", ADV_SPEC)
def q_advanced_features(spark, sf_dir):
    sd = store_daily_of(spark, sf_dir)
    w = features.series_window(["store_id"])
    return features.with_ewm(sd, "total_revenue").select(
        "date", "store_id", *[f"total_revenue_ewm_{s}" for s in EWM_SPANS], *features.advanced_columns("total_revenue", w))


def _advanced_sql() -> str:
    w = "PARTITION BY store_id ORDER BY date"
    ewm = []
    for s in EWM_SPANS:
        a = 2.0 / (s + 1.0)
        ewm.append(
            f"list_reduce(list(total_revenue) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"lambda acc, x: acc * CAST({1.0 - a!r} AS DOUBLE) + x * CAST({a!r} AS DOUBLE)) AS total_revenue_ewm_{s}"
        )
    ratios = []
    for k in (7, 30):
        r = f"total_revenue / ({G.window_mean('total_revenue', f'OVER ({w} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)')} + 1)"
        ratios += [f"{r} AS total_revenue_ratio_to_{k}d_avg", f"{r} AS total_revenue_ratio_to_{k}d"]
    return BASE + f"""
SELECT date, store_id, {', '.join(ewm)},
       row_number() OVER ({w}) - 1 AS trend,
       (row_number() OVER ({w}) - 1) * (row_number() OVER ({w}) - 1) AS trend_squared,
       total_revenue - lag(total_revenue, 1) OVER ({w}) AS total_revenue_velocity,
       (total_revenue - lag(total_revenue, 1) OVER ({w}))
         - (lag(total_revenue, 1) OVER ({w}) - lag(total_revenue, 2) OVER ({w})) AS total_revenue_acceleration,
       {', '.join(ratios)},
       day(date) AS day_of_month, CAST(day(date) <= 5 AS INTEGER) AS is_month_start,
       CAST(day(date) >= 25 AS INTEGER) AS is_month_end,
       CAST(floor((day(date) - 1) / 7) + 1 AS INTEGER) AS week_of_month,
       (month(date) - 1) % 3 + 1 AS quarter_progress,
       CAST((month(date) - 1) % 3 + 1 = 3 AS INTEGER) AS is_quarter_end,
       day(date) AS days_since_month_start,
       has_discount * CAST(isodow(date) - 1 >= 5 AS INTEGER) AS promotion_weekend
FROM store_daily"""


sql("advanced_features", _advanced_sql())


# --- W02, W08, T03: one day-grain series (orders revenue) ---------------------------
SERIES_SPEC = (
    "date:date, store_id:string, total_revenue:double, year:int, month:int, day:int, dayofweek:int, "
    f"quarter:int, weekofyear:int, is_weekend:int, {CYC_SPEC}, {LAG_SPEC}, {ROLL_SPEC}"
)


@query("series_features", SERIES_SPEC)
def q_series_features(spark, sf_dir):
    return features.single_series_features(T.orders_daily(spark, sf_dir))


def _series_sql() -> str:
    gen = G.lag_names() + G.rolling_names()
    fills = ", ".join(
        f"coalesce({c}, {'0.0' if c.endswith('_std') else '(SELECT avg(total_revenue) FROM h)'}) AS {c}" for c in gen
    )
    cal = [e for e in G.date_features() if not e.endswith("is_holiday")]
    return f"""WITH h AS (
  SELECT CAST(o_orderdate AS DATE) AS date, 'store_001' AS store_id,
         round(sum(o_totalprice) * 100.0) / 100.0 AS total_revenue
  FROM orders GROUP BY 1
),
f AS (
  SELECT date, store_id, total_revenue, {', '.join(cal)}, {', '.join(G.cyclical())},
         {', '.join(G.lags('total_revenue', 'store_id'))},
         {', '.join(G.rolling('total_revenue', 'store_id', full=True))}
  FROM h
)
SELECT * REPLACE ({fills}) FROM f"""


sql("series_features", _series_sql())


# --- W01–W09 along series of any length: single order lines of time, cut into blocks --
#: Rows of a block; small, so that the driver's tables are cut too.
SERIES_BLOCK = 4096
ORDER_LAGS, ORDER_WINDOWS = (1, 7, 30), (7, 30)


def _order_values(spark, sf_dir):
    """Every order with its nation; the value of pending orders is unknown (NULL)."""
    orders = T.read(spark, sf_dir, "orders").join(
        T.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left")
    return orders.select("o_orderkey", F.col("o_orderdate").alias("ordered"), F.col("c_nationkey").alias("nation"),
                         F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"))


_ORDER_VALUES = """WITH v AS (
  SELECT o_orderkey, o_orderdate AS ordered, c_nationkey AS nation, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)"""


@query("order_value_features", "o_orderkey:bigint, place:bigint, " + ", ".join(
    [f"value_lag_{k}:double" for k in ORDER_LAGS]
    + [f"value_rolling_{k}_{f}:double" + "@2" * (f == "std") for k in ORDER_WINDOWS for f in ("mean", "std", "min", "max", "median")]))
def q_order_value_features(spark, sf_dir):
    """All orders as one series without a key: lags and rolling statistics in blocks with a halo."""
    def build(w, place):
        return [place.alias("place"), *features.lag_columns("value", w, ORDER_LAGS), *features.rolling_columns("value", w, ORDER_WINDOWS)]

    return series.windowed(_order_values(spark, sf_dir), [], ["ordered", "o_orderkey"], build, max(ORDER_LAGS), SERIES_BLOCK)


def _order_features_sql() -> str:
    order = "ORDER BY ordered, o_orderkey"
    cols = [f"lag(value, {k}) OVER ({order}) AS value_lag_{k}" for k in ORDER_LAGS]
    for k in ORDER_WINDOWS:
        over = f"OVER ({order} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        cols.append(f"{G.window_mean('value', over)} AS value_rolling_{k}_mean")
        cols += [f"{f}(value) {over} AS value_rolling_{k}_{n}" for f, n in
                 (("stddev_samp", "std"), ("min", "min"), ("max", "max"), ("median", "median"))]
    return f"{_ORDER_VALUES}\nSELECT o_orderkey, row_number() OVER ({order}) - 1 AS place, {', '.join(cols)} FROM v"


sql("order_value_features", _order_features_sql())


@query("order_value_ewm", "o_orderkey:bigint, " + ", ".join(f"value_ewm_{s}:double@2" for s in EWM_SPANS))
def q_order_value_ewm(spark, sf_dir):
    """Exponentially weighted order value of each nation, with gaps, as a scan of affine maps."""
    return series.ewm(_order_values(spark, sf_dir), "value", EWM_SPANS, ["nation"], ["ordered", "o_orderkey"], 64)


def _order_ewm_sql() -> str:
    cols = []
    for s in EWM_SPANS:
        a = f"CAST({2.0 / (s + 1.0)!r} AS DOUBLE)"
        w = f"pow(1 - {a}, e.g)"
        cols.append(f"list_reduce(past, lambda y, e: {{'x': ({w} * y.x + {a} * e.x) / ({w} + {a}), 'g': e.g}}).x AS value_ewm_{s}")
    return f"""{_ORDER_VALUES}, p AS (
  SELECT *, row_number() OVER (PARTITION BY nation ORDER BY ordered, o_orderkey) AS pos FROM v
), seen AS (
  SELECT *, pos - max(CASE WHEN value IS NOT NULL THEN pos END) OVER (
           PARTITION BY nation ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM p
), l AS (
  SELECT o_orderkey, list({{'x': value, 'g': CAST(coalesce(gap, 0) AS DOUBLE)}}) FILTER (value IS NOT NULL) OVER (
           PARTITION BY nation ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS past
  FROM seen
)
SELECT o_orderkey, {', '.join(cols)} FROM l"""


sql("order_value_ewm", _order_ewm_sql())


# --- D16 -----------------------------------------------------------------------------
@query("interaction_features", "date:date, product_id:string, store_id_category_interaction:string")
def q_interaction_features(spark, sf_dir):
    daily = cleaning.daily_product_sales(T.sales(spark, sf_dir))
    return daily.select("date", "product_id", *features.interaction_columns(["store_id", "category"]))


sql(
    "interaction_features",
    with_ctes(SALES, DAILY) + "\nSELECT date, product_id, store_id || '_' || category AS store_id_category_interaction FROM daily",
)


# --- C03 / D08 -------------------------------------------------------------------------
@query("holiday_calendar", "date:date, holiday:string")
def q_holiday_calendar(spark, sf_dir):
    return holiday_calendar(T.sales(spark, sf_dir).select("date"))


sql(
    "holiday_calendar",
    with_ctes(SALES)
    + f""",
span AS (SELECT min(date) AS lo, max(date) AS hi FROM sales),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span)
SELECT date, {holiday_name_sql('date')} AS holiday FROM days WHERE {holiday_sql('date')}""",
)

