"""Registered forecast, rule-table and encoding queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.config import FORECAST_BAND, FORECAST_HORIZON, HISTORY_TAIL, LAGS, ROLLING_WINDOWS
from tillcast.functions.holidays import holiday_sql
from tillcast.operators import cleaning, encoding, forecast, rules, split
from tillcast.plans import sqlgen as G
from tillcast.plans.oracle import BASE, DAILY, PROMOTIONS, SALES, sql, with_ctes
from tillcast.plans.registry import query, store_daily_of
from tillcast.sources import tables as T


def _d(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


# --- forecast (U03, W14, W15, T01 features, T02, A07, P10) --------------------------------------
HISTORY_SQL = """WITH h AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date, printf('store_%03d', CAST(c.c_nationkey AS BIGINT)) AS store_id,
         round(sum(o.o_totalprice) * 100.0) / 100.0 AS total_revenue
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2
)"""


def _tail_sql() -> str:
    t = "total_revenue"
    n = f"count(CASE WHEN rn <= {HISTORY_TAIL} THEN {t} END)"
    cols = ["max(date) AS last_date"]
    for k in LAGS:
        cols.append(f"CASE WHEN {n} >= {k} THEN max(CASE WHEN rn = {k} THEN {t} END) ELSE avg({t}) END AS {t}_lag_{k}")
    for k in ROLLING_WINDOWS:
        x = f"CASE WHEN rn <= {k} THEN {t} END"
        full = f"{n} >= {k}"
        cols += [
            f"CASE WHEN {full} THEN avg({x}) ELSE avg({t}) END AS {t}_rolling_{k}_mean",
            f"CASE WHEN {full} THEN stddev_pop({x}) ELSE 0.0 END AS {t}_rolling_{k}_std",
            f"CASE WHEN {full} THEN min({x}) ELSE avg({t}) END AS {t}_rolling_{k}_min",
            f"CASE WHEN {full} THEN max({x}) ELSE avg({t}) END AS {t}_rolling_{k}_max",
            f"CASE WHEN {full} THEN quantile_cont({t}, 0.5) FILTER (WHERE rn <= {k}) ELSE avg({t}) END "
            f"AS {t}_rolling_{k}_median",
        ]
    cal = [e for e in G.date_features() if not e.endswith("is_holiday")]
    return HISTORY_SQL + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS rn FROM h),
st AS (SELECT store_id, {', '.join(cols)} FROM r GROUP BY store_id),
fut AS (
  SELECT st.* EXCLUDE (last_date),
         CAST(unnest(generate_series(last_date + 1, last_date + {FORECAST_HORIZON}, INTERVAL 1 DAY)) AS DATE) AS date
  FROM st
),
ff AS (
  SELECT *, {', '.join(cal)}, {', '.join(G.cyclical())},
         100 AS quantity_sold, 1000 AS profit, 0 AS has_discount, 500 AS customer_traffic, 0 AS is_holiday
  FROM fut
)"""


FC_SQL = _tail_sql()
_ROLL = ", ".join(f"{c}:double@2" if c.endswith("_std") else f"{c}:double" for c in G.rolling_names())
FORECAST_SPEC = (
    "date:date, store_id:string, " + ", ".join(f"{c}:double" for c in G.lag_names()) + f", {_ROLL}, "
    "year:int, month:int, day:int, dayofweek:int, quarter:int, weekofyear:int, is_weekend:int, "
    "month_sin:double, month_cos:double, day_sin:double, day_cos:double, dayofweek_sin:double, dayofweek_cos:double, "
    "quantity_sold:int, profit:int, has_discount:int, customer_traffic:int, is_holiday:int"
)


@query("forecast_features", FORECAST_SPEC)
def q_forecast_features(spark, sf_dir):
    return forecast.forecast_frame(T.orders_store_daily(spark, sf_dir))


sql("forecast_features", FC_SQL + "\nSELECT * FROM ff")


def _naive_forecast(spark, sf_dir):
    ff = forecast.forecast_frame(T.orders_store_daily(spark, sf_dir))
    preds = ff.select("date", "store_id", F.col("total_revenue_rolling_7_mean").alias("predicted_sales"))
    return forecast.with_band(preds)


@query("forecast_band", "date:date, store_id:string, predicted_sales:double, lower_bound:double, upper_bound:double")
def q_forecast_band(spark, sf_dir):
    return _naive_forecast(spark, sf_dir)


sql(
    "forecast_band",
    FC_SQL + f"\nSELECT date, store_id, total_revenue_rolling_7_mean AS predicted_sales, "
    f"total_revenue_rolling_7_mean * {_d(1 - FORECAST_BAND)} AS lower_bound, "
    f"total_revenue_rolling_7_mean * {_d(1 + FORECAST_BAND)} AS upper_bound FROM ff",
)


@query(
    "forecast_summary",
    "store_id:string, total_predicted_sales:double@2, average_daily_sales:double@2, max_daily_sales:double, "
    "min_daily_sales:double",
)
def q_forecast_summary(spark, sf_dir):
    return forecast.forecast_summary(_naive_forecast(spark, sf_dir))


sql(
    "forecast_summary",
    FC_SQL + "\nSELECT store_id, sum(total_revenue_rolling_7_mean) AS total_predicted_sales, "
    "avg(total_revenue_rolling_7_mean) AS average_daily_sales, max(total_revenue_rolling_7_mean) AS max_daily_sales, "
    "min(total_revenue_rolling_7_mean) AS min_daily_sales FROM ff GROUP BY store_id",
)


@query("history_and_forecast", "date:date, store_id:string, value:double, kind:string")
def q_history_and_forecast(spark, sf_dir):
    return forecast.history_and_forecast(T.orders_store_daily(spark, sf_dir), _naive_forecast(spark, sf_dir))


sql(
    "history_and_forecast",
    FC_SQL + "\nSELECT date, store_id, total_revenue AS value, 'history' AS kind FROM h "
    "UNION ALL SELECT date, store_id, total_revenue_rolling_7_mean, 'forecast' FROM ff",
)


@query("store_numbers", "store_id:string, store_number:int")
def q_store_numbers(spark, sf_dir):
    return T.orders_store_daily(spark, sf_dir).select("store_id").distinct().select(
        "store_id", forecast.store_number("store_id").alias("store_number"))


sql(
    "store_numbers",
    HISTORY_SQL + "\nSELECT DISTINCT store_id, CASE WHEN contains(store_id, 'store_') AND "
    "regexp_extract(store_id, '(\\d+)', 1) <> '' THEN CAST(regexp_extract(store_id, '(\\d+)', 1) AS INTEGER) ELSE 1 END "
    "AS store_number FROM h",
)


# --- promotions, store events, demand factors (C02, J04, D21, D22) -------------------------------
@query("promotion_calendar", "date:date, promotion_type:string, discount_percent:double")
def q_promotion_calendar(spark, sf_dir):
    return rules.promotion_days(T.promotions(spark, sf_dir))


sql("promotion_calendar", with_ctes(PROMOTIONS) + """
SELECT CAST(date AS DATE) AS date, promotion_type, max(discount_percent) AS discount_percent
FROM promotions WHERE date IS NOT NULL GROUP BY 1, 2""")

EVENT_INTERVALS_SQL = f"""ev AS (
  SELECT printf('store_%03d', CAST(user_id % (SELECT count(*) FROM nation) AS BIGINT)) AS store_id,
         CAST(CAST(ts AS DATE) - {T.EVENT_DAY_SHIFT} AS DATE) AS start_date,
         CASE WHEN value < 100 THEN 'closure' ELSE 'renovation' END AS event_type,
         CASE WHEN value < 100 THEN -1.0 ELSE -0.3 END AS impact,
         CASE WHEN value < 100 THEN 1 ELSE 7 + event_id % 15 END AS duration_days
  FROM events WHERE event_type = 'error'
),
ev_days AS (
  SELECT store_id, CAST(unnest(generate_series(start_date, start_date + CAST(duration_days - 1 AS INTEGER),
                                               INTERVAL 1 DAY)) AS DATE) AS date, event_type, impact
  FROM ev
)"""


@query("store_event_days", "store_id:string, date:date, event_type:string, impact:double")
def q_store_event_days(spark, sf_dir):
    return rules.expand_intervals(T.store_event_intervals(spark, sf_dir))


sql("store_event_days", "WITH " + EVENT_INTERVALS_SQL + "\nSELECT * FROM ev_days")


@query("store_event_factors", "date:date, store_id:string, event_factor:double")
def q_store_event_factors(spark, sf_dir):
    days = store_daily_of(spark, sf_dir).select("date", "store_id")
    return rules.store_event_factor(days, rules.expand_intervals(T.store_event_intervals(spark, sf_dir)))


sql(
    "store_event_factors",
    BASE + ",\n" + EVENT_INTERVALS_SQL + """,
e AS (SELECT store_id, date, min(impact) AS impact FROM ev_days GROUP BY store_id, date)
SELECT s.date, s.store_id, coalesce(1 + e.impact, 1.0) AS event_factor
FROM store_daily s LEFT JOIN e ON s.store_id = e.store_id AND s.date = e.date""",
)


@query("demand_factors", "date:date, dow_factor:double, month_factor:double, holiday_factor:double")
def q_demand_factors(spark, sf_dir):
    return rules.demand_factors(T.sales(spark, sf_dir).select("date", "revenue"))


sql(
    "demand_factors",
    with_ctes(SALES) + f""",
d AS (SELECT date, round(sum(revenue) * 10000.0) / 10000.0 AS r, {holiday_sql('date')} AS h
      FROM sales WHERE date IS NOT NULL GROUP BY date)
SELECT date, avg(r) OVER (PARTITION BY isodow(date)) / avg(r) OVER () AS dow_factor,
       avg(r) OVER (PARTITION BY month(date)) / avg(r) OVER () AS month_factor,
       CASE WHEN h THEN avg(r) OVER (PARTITION BY h) / avg(r) OVER () ELSE 1.0 END AS holiday_factor
FROM d""",
)


# --- encoders (N05, N06, N07, A08, A09) --------------------------------------------------------
@query("label_encoding", "store_id:string, store_id_index:int")
def q_label_encoding(spark, sf_dir):
    return encoding.fit_label_encoder(store_daily_of(spark, sf_dir), "store_id")


sql("label_encoding", BASE + "\nSELECT store_id, dense_rank() OVER (ORDER BY store_id) - 1 AS store_id_index "
    "FROM (SELECT DISTINCT store_id FROM store_daily WHERE store_id IS NOT NULL)")

SCALE_COLS = ["has_discount", "total_revenue", "quantity_sold", "profit", "customer_traffic"]


@query("standard_scaler", "column:string, mean:double@2, std:double@2")
def q_standard_scaler(spark, sf_dir):
    sp = split.chronological_split(store_daily_of(spark, sf_dir), target="total_revenue")
    return encoding.fit_scaler(sp.where(F.col("split") == "train"), SCALE_COLS)


def _scaler_sql() -> str:
    from tillcast.plans.q_evaluation import TRAIN_FRAC, VAL_FRAC  # same split arithmetic

    parts = [
        f"SELECT '{c}' AS column, avg({c}) AS mean, "
        f"CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 ELSE stddev_pop({c}) END AS std FROM tr"
        for c in SCALE_COLS
    ]
    return BASE + f""",
pos AS (SELECT *, row_number() OVER (ORDER BY date, store_id) - 1 AS position, count(*) OVER () AS _n FROM store_daily),
tr AS (SELECT * FROM pos WHERE position < floor(_n * {_d(TRAIN_FRAC)}) AND total_revenue IS NOT NULL)
""" + "\nUNION ALL ".join(parts)


sql("standard_scaler", _scaler_sql())


@query(
    "target_encoding",
    "category:string, n:bigint, category_mean:double@2, global_mean:double@2, category_target_encoded:double@2",
)
def q_target_encoding(spark, sf_dir):
    daily = cleaning.daily_product_sales(T.sales(spark, sf_dir))
    return encoding.fit_target_encoder(daily, "total_revenue", "category")


sql(
    "target_encoding",
    with_ctes(SALES, DAILY)
    + """,
g AS (SELECT avg(total_revenue) AS gm FROM daily)
SELECT category, count(*) AS n, avg(total_revenue) AS category_mean, any_value(g.gm) AS global_mean,
       (count(*) * avg(total_revenue) + 1.0 * any_value(g.gm)) / (count(*) + 1.0) AS category_target_encoded
FROM daily, g GROUP BY category""",
)


@query("target_encoded_sales", "date:date, store_id:string, product_id:string, category:string, category_target_encoded:double@2")
def q_target_encoded_sales(spark, sf_dir):
    daily = cleaning.daily_product_sales(T.sales(spark, sf_dir))
    encoder = encoding.fit_target_encoder(daily, "total_revenue", "category")
    return encoding.apply_target_encoder(daily, encoder, "category")


sql(
    "target_encoded_sales",
    with_ctes(SALES, DAILY) + """,
g AS (SELECT avg(total_revenue) AS gm FROM daily),
e AS (SELECT category, (sum(total_revenue) + gm) / (count(*) + 1.0) AS v FROM daily, g GROUP BY category, gm)
SELECT date, store_id, product_id, d.category, e.v AS category_target_encoded FROM daily d JOIN e ON d.category = e.category""",
)


@query("scaled_store_days", "date:date, store_id:string, " + ", ".join(f"{c}:double@2" for c in SCALE_COLS))
def q_scaled_store_days(spark, sf_dir):
    days = store_daily_of(spark, sf_dir)
    train = split.chronological_split(days, target="total_revenue").where(F.col("split") == "train")
    return encoding.apply_scaler(days, encoding.fit_scaler(train, SCALE_COLS), SCALE_COLS)


def _scaled_sql() -> str:
    from tillcast.plans.q_evaluation import TRAIN_FRAC  # same split arithmetic

    stats = ", ".join(f"avg({c}) AS {c}_m, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS {c}_s" for c in SCALE_COLS)
    cols = ", ".join(f"(d.{c} - {c}_m) / {c}_s AS {c}" for c in SCALE_COLS)
    return BASE + f""",
pos AS (SELECT *, row_number() OVER (ORDER BY date, store_id) - 1 AS position, count(*) OVER () AS _n FROM store_daily),
m AS (SELECT {stats} FROM pos WHERE position < floor(_n * {_d(TRAIN_FRAC)}) AND total_revenue IS NOT NULL)
SELECT date, store_id, {cols} FROM store_daily d, m"""


sql("scaled_store_days", _scaled_sql())


# --- MLlib models (M01–M05, M07, M08, M10, M11, O03, R09, T01) ---------------------------------
# Trained trees are beyond SQL; what follows from their predictions is checked in tests/test_training.py.
_BUNDLES: dict = {}


def _trained(spark, sf_dir):
    """One training run for all queries of a session on the same files; its store-days are kept as the table ``history``."""
    from tillcast.plans import q_evaluation, training
    from tillcast.session import materialize

    key = (spark.sparkContext.applicationId, sf_dir, T.state(spark, sf_dir))
    if key not in _BUNDLES:
        _BUNDLES.clear()
        days = materialize(store_daily_of(spark, sf_dir))
        bundle = training.train_all(spark, materialize(q_evaluation.labeled_of(days)))
        bundle.tables["history"] = days
        _BUNDLES[key] = bundle
    return _BUNDLES[key]


@query("gbt_test_metrics", "split:string, model:string, metric:string, value:double")
def q_gbt_test_metrics(spark, sf_dir):
    return _trained(spark, sf_dir).tables["metrics"]


@query("gbt_test_predictions", "date:date, store_id:string, split:string, model:string, actual:double, prediction:double")
def q_gbt_test_predictions(spark, sf_dir):
    return _trained(spark, sf_dir).tables["predictions"]


@query("gbt_top_features", "model:string, feature:string, importance:double, rank:int")
def q_gbt_top_features(spark, sf_dir):
    from tillcast.operators import diagnostics

    return diagnostics.top_features(_trained(spark, sf_dir).tables["importance"])


@query("gbt_search_trials", "model:string, trial:int, rung:int, params:string, rounds:int, best_round:int, rmse:double, kept:boolean")
def q_gbt_search_trials(spark, sf_dir):
    """A short search of both spaces: four draws of at most 9 rounds, depths up to 4, two rungs."""
    from tillcast.config import SEARCH_SPACE_A, SEARCH_SPACE_B
    from tillcast.plans import q_evaluation, training
    from tillcast.session import materialize

    labeled = materialize(q_evaluation.labeled(spark, sf_dir))
    short = {"maxIter": (3, 9)}
    spaces = {"model_a": SEARCH_SPACE_A | short | {"maxDepth": (3, 4)}, "model_b": SEARCH_SPACE_B | short | {"numLeaves": (8, 16)}}
    tables = [
        training.halving_search(labeled, space, trials=4, rungs=2)[1].withColumn("model", F.lit(name)) for name, space in spaces.items()
    ]
    return tables[0].unionByName(tables[1])


def _model_forecast(spark, sf_dir):
    from tillcast.plans import training

    bundle = _trained(spark, sf_dir)
    return training.model_forecast(bundle, bundle.tables["history"])


@query("model_forecast", "date:date, store_id:string, model:string, predicted_sales:double, lower_bound:double, upper_bound:double")
def q_model_forecast(spark, sf_dir):
    return _model_forecast(spark, sf_dir)


@query(
    "model_forecast_intervals",
    "date:date, store_id:string, model:string, predicted_sales:double, lower_80:double, upper_80:double, lower_95:double, "
    "upper_95:double",
)
def q_model_forecast_intervals(spark, sf_dir):
    from tillcast.plans import training

    return training.forecast_intervals(_trained(spark, sf_dir), _model_forecast(spark, sf_dir))


@query(
    "model_forecast_summary",
    "store_id:string, model:string, total_predicted_sales:double@2, average_daily_sales:double@2, max_daily_sales:double, "
    "min_daily_sales:double",
)
def q_model_forecast_summary(spark, sf_dir):
    return forecast.forecast_summary(_model_forecast(spark, sf_dir), group_cols=("store_id", "model"))
