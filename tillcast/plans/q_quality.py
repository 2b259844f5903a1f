"""Registered data-quality queries (V rows) and their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillcast.config import IQR_MULTIPLIER, VALUE_RANGES, ZSCORE_LIMIT
from tillcast.operators import cleaning, profiles, quality
from tillcast.plans.oracle import BASE, DAILY, PROMOTIONS, SALES, TRAFFIC, TRAFFIC_SUMMARY, sql, with_ctes
from tillcast.plans.registry import query, store_daily_of
from tillcast.session import ensure_checkpoint_dir, materialize
from tillcast.sources import files, ingest, quarantine, tables as T

# The cleaning input as it arrives: product lines with store traffic attached
# (traffic is missing for many store-days, so the profile sees real NULLs).
QI_COLUMNS = [
    ("date", "date"), ("store_id", "string"), ("product_id", "string"), ("category", "string"),
    ("quantity_sold", "bigint"), ("total_revenue", "double"), ("cost", "double"), ("discount_percent", "double"),
    ("profit", "double"), ("unit_price", "double"), ("customer_traffic", "bigint"), ("is_holiday", "int"),
]
QI_NUMERIC = [c for c, t in QI_COLUMNS if t in ("bigint", "double", "int")]


def quality_input(spark, sf_dir):
    daily = cleaning.daily_product_sales(T.sales(spark, sf_dir))
    traffic = cleaning.traffic_summary(T.customer_traffic(spark, sf_dir))
    return cleaning.with_traffic(daily, traffic).select(*[c for c, _ in QI_COLUMNS])


QI_SQL = with_ctes(SALES, TRAFFIC, DAILY, TRAFFIC_SUMMARY) + f""",
qi AS (
  SELECT {', '.join('d.' + c if c not in ('customer_traffic', 'is_holiday') else 't.' + c for c, _ in QI_COLUMNS)}
  FROM daily d LEFT JOIN traffic_summary t ON d.date = t.date AND d.store_id = t.store_id
)"""


# --- V02/V03: per day-partition checks ----------------------------------------------
@query("partition_checks", "date:date, rows:bigint, negative_revenue:boolean, negative_quantity_sold:boolean")
def q_partition_checks(spark, sf_dir):
    return quality.partition_checks(T.sales(spark, sf_dir), "date", ["revenue", "quantity_sold"])


sql(
    "partition_checks",
    with_ctes(SALES)
    + "\nSELECT date, count(*) AS rows, bool_or(revenue < 0) AS negative_revenue, "
    "bool_or(quantity_sold < 0) AS negative_quantity_sold FROM sales GROUP BY date",
)


# --- V01–V03 file by file -----------------------------------------------------------------
#: Months whose files lack revenue, and whose files hold quantities as text.
WITHOUT_REVENUE, TEXT_QUANTITY = 2, 3


@query("ingest_file_checks", "month:string, rows:bigint, issues:string")
def q_ingest_file_checks(spark, sf_dir):
    """All sales as month files, some with another schema and one without rows, checked from their footers."""
    cols = ["date", "store_id", "product_id", "quantity_sold", "revenue", "profit"]
    sales = T.sales(spark, sf_dir).select(*cols, F.date_format("date", "yyyy-MM").alias("month"))
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/month-files-{uuid.uuid4().hex}"
    number = F.month("date")
    for part in (
        sales.where(~number.isin(WITHOUT_REVENUE, TEXT_QUANTITY) | number.isNull()),
        sales.where(number == WITHOUT_REVENUE).drop("revenue"),
        sales.where(number == TEXT_QUANTITY).withColumn("quantity_sold", F.col("quantity_sold").cast("string")),
    ):
        part.hint("rebalance", "month").write.mode("append").partitionBy("month").parquet(root)
    sales.where("false").drop("month", "revenue").coalesce(1).write.parquet(f"{root}/month=none")
    expected = {"date": "date", "store_id": "string", "product_id": "string", "quantity_sold": "bigint", "revenue": "double"}
    report = ingest.file_report(spark, root, expected, ["revenue", "quantity_sold", "profit"])
    named = report.withColumn("month", F.regexp_extract("file", "month=([^/]+)/", 1))
    found = F.transform("issues", lambda x: F.concat_ws(":", x["issue"], x["column"]))
    return named.groupBy("month").agg(
        F.sum("rows").alias("rows"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(found)))), ",").alias("issues"))


sql(
    "ingest_file_checks",
    with_ctes(SALES)
    + f""",
m AS (SELECT strftime(date, '%Y-%m') AS month, month(date) AS number, count(*) AS rows, bool_or(revenue < 0) AS r,
             bool_or(quantity_sold < 0) AS q, bool_or(profit < 0) AS p FROM sales GROUP BY 1, 2)
SELECT month, rows, array_to_string(list_sort([x FOR x IN [
         CASE WHEN number = {WITHOUT_REVENUE} THEN 'missing:revenue' WHEN r THEN 'negative:revenue' END,
         CASE WHEN number = {TEXT_QUANTITY} THEN 'type:quantity_sold' WHEN q THEN 'negative:quantity_sold' END,
         CASE WHEN p THEN 'negative:profit' END] IF x IS NOT NULL]), ',') AS issues
FROM m UNION ALL SELECT 'none', 0, 'empty,missing:revenue'""",
)


# --- V04: issue summary ------------------------------------------------------------------
@query("partition_issue_report", "rows_checked:bigint, issue_count:bigint, first_issues:string")
def q_partition_issue_report(spark, sf_dir):
    cols = ["revenue", "quantity_sold", "profit"]
    checks = quality.partition_checks(T.sales(spark, sf_dir), "date", cols)
    return quality.issue_report(checks, quality.issue_rows(checks, "date", cols), "date")


sql(
    "partition_issue_report",
    with_ctes(SALES)
    + """,
checks AS (SELECT date, count(*) AS rows, bool_or(revenue < 0) AS nr, bool_or(quantity_sold < 0) AS nq,
                  bool_or(profit < 0) AS np FROM sales GROUP BY date),
issues AS (
  SELECT date, 'negative_revenue' AS issue FROM checks WHERE nr
  UNION ALL SELECT date, 'negative_quantity_sold' FROM checks WHERE nq
  UNION ALL SELECT date, 'negative_profit' FROM checks WHERE np
),
firsts AS (SELECT * FROM issues ORDER BY date, issue LIMIT 5)
SELECT (SELECT sum(rows) FROM checks) AS rows_checked,
       (SELECT count(*) FROM issues) AS issue_count,
       (SELECT coalesce(string_agg(CAST(date AS VARCHAR) || ': ' || issue, '; ' ORDER BY CAST(date AS VARCHAR) || ': ' || issue), '')
        FROM firsts) AS first_issues""",
)


# --- V02: store-day partitions without rows ------------------------------------------
@query("empty_store_days", "store_id:string, date:date")
def q_empty_store_days(spark, sf_dir):
    sales = T.sales(spark, sf_dir).select("store_id", "date")
    span = sales.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    expected = sales.select("store_id").distinct().select("store_id", F.explode(F.sequence(lo, hi)).alias("date"))
    return expected.join(sales.distinct(), ["store_id", "date"], "left_anti")


sql(
    "empty_store_days",
    with_ctes(SALES)
    + """,
span AS (SELECT min(date) AS lo, max(date) AS hi FROM sales),
expected AS (
  SELECT s.store_id, CAST(unnest(generate_series(span.lo, span.hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT store_id FROM sales) s, span
)
SELECT e.store_id, e.date FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM sales x WHERE x.store_id = e.store_id AND x.date = e.date)""",
)


# --- V05 ------------------------------------------------------------------------------------
EVENT_TYPES = {"value": "double", "props": "double", "user_id": "string", "event_type": "double"}


@query("type_check", "column:string, actual_type:string, expected_type:string, failed:bigint")
def q_type_check(spark, sf_dir):
    return quality.type_check(T.read(spark, sf_dir, "events"), EVENT_TYPES)


sql(
    "type_check",
    "WITH c AS (SELECT "
    + ", ".join(
        f"count_if({c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {t.upper()}) IS NULL) AS {c}"
        for c, t in EVENT_TYPES.items()
    )
    + " FROM events)\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, '{a}' AS actual_type, '{t}' AS expected_type, {c} AS failed FROM c"
        for (c, t), a in zip(EVENT_TYPES.items(), ("double", "string", "bigint", "string"))
    ),
)


# --- V06 ------------------------------------------------------------------------------------
@query("duplicate_rows", "duplicate_rows:bigint")
def q_duplicate_rows(spark, sf_dir):
    ev = T.read(spark, sf_dir, "events")
    return quality.duplicate_rows(ev.select("user_id", "event_type", F.to_date("ts").alias("day")))


sql(
    "duplicate_rows",
    "SELECT coalesce(sum(n - 1), 0) AS duplicate_rows FROM "
    "(SELECT count(*) AS n FROM events GROUP BY user_id, event_type, CAST(ts AS DATE))",
)


WHOLE_TABLES = ("customer", "events", "lineitem", "orders", "part", "supplier")


@query("repeated_table_rows", "table:string, duplicate_rows:bigint")
def q_repeated_table_rows(spark, sf_dir):
    """Repeated rows over all columns of the tables, and of the events with their errors delivered twice."""
    tables = {name: T.read(spark, sf_dir, name) for name in WHOLE_TABLES}
    tables["events_redelivered"] = tables["events"].union(tables["events"].where("event_type = 'error'"))
    parts = [quality.repeated_rows(df).select(F.lit(name).alias("table"), "duplicate_rows") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


sql(
    "repeated_table_rows",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS duplicate_rows"
        for t in WHOLE_TABLES)
    + "\nUNION ALL SELECT 'events_redelivered', (SELECT count(*) FROM events) + (SELECT count(*) FROM events WHERE event_type = 'error')"
    " - (SELECT count(*) FROM (SELECT DISTINCT * FROM events))",
)


# --- S03: a history file with lines that cannot be read ----------------------------------------
BAD_DATE_DAY, BAD_NUMBER_DAY = 13, 17


@query("history_csv_checks", "failed:string, rows:bigint, total_revenue:double@2")
def q_history_csv_checks(spark, sf_dir):
    """All store-days as a CSV whose dates on one day of the month, and numbers on another, are no such."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/history-csv-{uuid.uuid4().hex}"
    day = F.dayofmonth("date")
    store_daily_of(spark, sf_dir).select(
        F.when(day == BAD_DATE_DAY, "some day").otherwise(F.col("date").cast("string")).alias("date"), "store_id",
        F.when(day == BAD_NUMBER_DAY, "n/a").otherwise(F.col("total_revenue").cast("string")).alias("total_revenue"),
    ).write.option("header", True).csv(root)
    lines = files.read_history_checked(spark, root)
    return lines.groupBy(F.array_join("failed", ",").alias("failed")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_revenue").alias("total_revenue"))


sql(
    "history_csv_checks",
    BASE
    + f""",
f AS (SELECT CASE day(date) WHEN {BAD_DATE_DAY} THEN 'date' WHEN {BAD_NUMBER_DAY} THEN 'total_revenue' ELSE '' END AS failed,
             CASE WHEN day(date) <> {BAD_NUMBER_DAY} THEN total_revenue END AS total_revenue FROM store_daily)
SELECT failed, count(*) AS rows, sum(total_revenue) AS total_revenue FROM f GROUP BY failed""",
)


# --- V07–V09 ------------------------------------------------------------------------------
@query("column_profile", "column:string, metric:string, value:double@2")
def q_column_profile(spark, sf_dir):
    return quality.column_profile(materialize(quality_input(spark, sf_dir)))


def _profile_sql() -> str:
    parts = []
    for c, t in QI_COLUMNS:
        parts += [
            f"SELECT '{c}' AS column, 'null_count' AS metric, CAST(count_if({c} IS NULL) AS DOUBLE) AS value FROM qi",
            f"SELECT '{c}', 'null_percentage', count_if({c} IS NULL) * 100.0 / count(*) FROM qi",
            f"SELECT '{c}', 'unique_values', CAST(count(DISTINCT {c}) AS DOUBLE) FROM qi",
        ]
        if c in QI_NUMERIC:
            x = f"CAST({c} AS DOUBLE)"
            parts += [
                f"SELECT '{c}', 'mean', avg({x}) FROM qi",
                f"SELECT '{c}', 'std', stddev_samp({x}) FROM qi",
                f"SELECT '{c}', 'min', min({x}) FROM qi",
                f"SELECT '{c}', 'max', max({x}) FROM qi",
            ]
    return QI_SQL + "\n" + "\nUNION ALL ".join(parts)


sql("column_profile", _profile_sql())


# --- V07–V09, V17, V19 from profiles kept by day ------------------------------------------
PROFILE_COLS = ["store_id", "product_id", "category", "quantity_sold", "revenue", "cost", "profit", "discount_percent"]
PROFILE_NUMBERS = PROFILE_COLS[3:]


def _kept_profiles(spark, sf_dir):
    """Profiles of all days of the sales, as two deliveries leave them: odd days first, then the even ones."""
    sales = T.sales(spark, sf_dir).select("date", *PROFILE_COLS)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/day-profiles-{uuid.uuid4().hex}"
    odd = F.dayofmonth("date") % 2 == 1
    profiles.store_profiles(profiles.day_profiles(sales.where(odd), "date", PROFILE_COLS), root)
    profiles.store_profiles(profiles.day_profiles(sales.where(~odd), "date", PROFILE_COLS), root)
    return spark.read.parquet(root)


@query("merged_profile", "column:string, rows:bigint, nulls:bigint, mean:double@2, std:double@2, min:double, max:double")
def q_merged_profile(spark, sf_dir):
    return profiles.merged(_kept_profiles(spark, sf_dir)).withColumnsRenamed({"lo": "min", "hi": "max"})


sql(
    "merged_profile",
    with_ctes(SALES)
    + "\nSELECT * FROM ("
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, "
        + (f"avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max"
           if c in PROFILE_NUMBERS else "NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS max")
        + " FROM sales WHERE date IS NOT NULL" for c in PROFILE_COLS)
    + ") WHERE rows > 0",
)


@query("sketch_accuracy", "column:string, distinct_values:bigint, distinct_close:boolean, quantiles_close:boolean")
def q_sketch_accuracy(spark, sf_dir):
    """The merged sketches against exact counts and ranks of the same rows, within the stated errors."""
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    kept = profiles.merged(_kept_profiles(spark, sf_dir)).select(
        "column", "n", profiles.distinct_count().alias("guess"), profiles.quantiles(probs).alias("at"))
    sales = T.sales(spark, sf_dir).where("date IS NOT NULL")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("s"),
                               (F.col(c).cast("double") if c in PROFILE_NUMBERS else F.lit(None).cast("double")).alias("x"))
                      for c in PROFILE_COLS])
    values = sales.select(F.explode(pairs).alias("p")).select("p.*").groupBy("column", "s", "x").agg(F.count(F.lit(1)).alias("k"))
    # one row per profiled column
    placed = values.join(F.broadcast(kept), "column")
    below = [F.sum(F.when(F.col("x") < F.col("at")[i], F.col("k")).otherwise(0)) for i in range(len(probs))]
    upto = [F.sum(F.when(F.col("x") <= F.col("at")[i], F.col("k")).otherwise(0)) for i in range(len(probs))]
    slack = F.lit(profiles.RANK_ERROR) * F.first("n")
    near = [(lo - slack <= p * F.first("n")) & (hi + slack >= p * F.first("n")) for p, lo, hi in zip(probs, below, upto)]
    within = near[0]
    for x in near[1:]:
        within = within & x
    out = placed.groupBy("column").agg(
        F.count("s").alias("distinct_values"), F.first("guess").alias("guess"),
        F.when(F.first("n") > 0, within).otherwise(True).alias("quantiles_close"))  # no numbers, none wrong
    error = F.abs(F.col("guess") - F.col("distinct_values"))
    return out.withColumn("distinct_close", error <= F.col("distinct_values") * profiles.DISTINCT_ERROR + 1)


sql(
    "sketch_accuracy",
    with_ctes(SALES)
    + "\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values, true AS distinct_close, "
        "true AS quantiles_close "
        "FROM sales WHERE date IS NOT NULL HAVING count(*) > 0" for c in PROFILE_COLS),
)


# --- V04/V13 while rows come in ----------------------------------------------------------
INGEST_RANGES = {"quantity_sold": (1, 45), "revenue": (0.0, 50_000.0), "profit": (0.0, 1_000_000.0)}


@query("ingest_quarantine", "rule:string, failed:bigint, passed:bigint, quarantined:bigint, good_rows:bigint")
def q_ingest_quarantine(spark, sf_dir):
    """All sales written in one pass: observed counts beside the rows found in either output."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/ingest-{uuid.uuid4().hex}"
    done = quarantine.ingest(T.sales(spark, sf_dir), quality.contract_rules(INGEST_RANGES), root)
    held = done.failed.select(F.explode("failed_rules").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("quarantined"))
    good = done.good.agg(F.count(F.lit(1)).alias("good_rows"))
    return done.counts.join(held, "rule", "left").fillna(0, ["quarantined"]).crossJoin(good)  # one row


def _quarantine_sql() -> str:
    rules = {f"{c}_{name}": f"{c} {op} {bound!r}" for c, (lo, hi) in INGEST_RANGES.items()
             for name, op, bound in (("ge_min", "<", lo), ("le_max", ">", hi))}
    any_rule = " OR ".join(f"coalesce({e}, false)" for e in rules.values())
    return with_ctes(SALES) + f",\ng AS (SELECT count_if(NOT ({any_rule})) AS good_rows FROM sales)\n" + "\nUNION ALL ".join(
        f"SELECT '{r}' AS rule, count_if({e}) AS failed, count(*) - count_if({e}) AS passed, count_if({e}) AS quarantined, "
        f"(SELECT good_rows FROM g) AS good_rows FROM sales" for r, e in rules.items())


sql("ingest_quarantine", _quarantine_sql())


# --- V10/V11 ------------------------------------------------------------------------------
# the bounds pass and the counting pass read the same joined input: checkpoint it once
@query("outliers_iqr", "column:string, outliers:bigint, method:string")
def q_outliers_iqr(spark, sf_dir):
    return quality.outlier_counts(materialize(quality_input(spark, sf_dir).select(*QI_NUMERIC)), "iqr", QI_NUMERIC)


@query("outliers_zscore", "column:string, outliers:bigint, method:string")
def q_outliers_zscore(spark, sf_dir):
    return quality.outlier_counts(materialize(quality_input(spark, sf_dir).select(*QI_NUMERIC)), "zscore", QI_NUMERIC)


def _outliers_sql(method: str) -> str:
    stats, parts = [], []
    for c in QI_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        if method == "iqr":
            stats += [f"quantile_cont({x}, 0.25) AS {c}_q1", f"quantile_cont({x}, 0.75) AS {c}_q3"]
            lo = f"(s.{c}_q1 - {IQR_MULTIPLIER} * (s.{c}_q3 - s.{c}_q1))"
            hi = f"(s.{c}_q3 + {IQR_MULTIPLIER} * (s.{c}_q3 - s.{c}_q1))"
            cond = f"qi.{c} < {lo} OR qi.{c} > {hi}"
        else:
            stats += [f"avg({c}) AS {c}_m", f"stddev_samp({c}) AS {c}_s"]
            cond = f"abs((qi.{c} - s.{c}_m) / s.{c}_s) > {ZSCORE_LIMIT}"
        parts.append(f"SELECT '{c}' AS column, count_if({cond}) AS outliers, '{method}' AS method FROM qi, s")
    return QI_SQL + f",\ns AS (SELECT {', '.join(stats)} FROM qi)\n" + "\nUNION ALL ".join(parts)


sql("outliers_iqr", _outliers_sql("iqr"))
sql("outliers_zscore", _outliers_sql("zscore"))


# --- V12 ------------------------------------------------------------------------------------
@query("range_breaches", "column:string, check:string, observed:double, bound:double, breached:boolean")
def q_range_breaches(spark, sf_dir):
    return quality.range_breaches(store_daily_of(spark, sf_dir))


_lo, _hi = VALUE_RANGES["total_revenue"]
sql(
    "range_breaches",
    BASE
    + f"""
SELECT 'total_revenue' AS column, 'below_minimum' AS "check", min(total_revenue) AS observed,
       CAST({_lo!r} AS DOUBLE) AS bound, min(total_revenue) < {_lo!r} AS breached FROM store_daily
UNION ALL
SELECT 'total_revenue', 'above_maximum', max(total_revenue), CAST({_hi!r} AS DOUBLE), max(total_revenue) > {_hi!r}
FROM store_daily""",
)


# --- V13 ------------------------------------------------------------------------------------
# the configured range, and one on quantities that real store-days do leave
CONTRACT_RANGES = VALUE_RANGES | {"quantity_sold": (1.0, 60.0)}
CONTRACT_TYPES = {"date": "date", "total_revenue": "double", "store_id": "string"}
_RULES_SQL = {
    f"{c}_type": f"{c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {t}) IS NULL"
    for c, t in (("date", "DATE"), ("total_revenue", "DOUBLE"), ("store_id", "VARCHAR"))
} | {
    "total_revenue_ge_min": f"total_revenue < {_lo!r}",
    "total_revenue_le_max": f"total_revenue > {_hi!r}",
    "quantity_sold_ge_min": "quantity_sold < 1.0",
    "quantity_sold_le_max": "quantity_sold > 60.0",
}


@query("contract_summary", "rule:string, failed:bigint, passed:bigint")
def q_contract_summary(spark, sf_dir):
    return quality.contract_summary(store_daily_of(spark, sf_dir), quality.contract_rules(CONTRACT_RANGES, CONTRACT_TYPES))


@query("contract_failures", "date:date, store_id:string, total_revenue:double, failed_rule:string")
def q_contract_failures(spark, sf_dir):
    failed = quality.contract_failures(store_daily_of(spark, sf_dir), quality.contract_rules(CONTRACT_RANGES, CONTRACT_TYPES))
    return failed.select("date", "store_id", "total_revenue", "failed_rule")


sql("contract_summary", BASE + "\n" + "\nUNION ALL ".join(
    f"SELECT '{n}' AS rule, count_if({c}) AS failed, count(*) - count_if({c}) AS passed FROM store_daily"
    for n, c in _RULES_SQL.items()))
sql("contract_failures", BASE + "\n" + "\nUNION ALL ".join(
    f"SELECT date, store_id, total_revenue, '{n}' AS failed_rule FROM store_daily WHERE {c}" for n, c in _RULES_SQL.items()))


# --- V14–V16 ------------------------------------------------------------------------------
@query("date_range", "start:date, end:date, days:int")
def q_date_range(spark, sf_dir):
    return quality.date_range(store_daily_of(spark, sf_dir))


sql("date_range", BASE + '\nSELECT min(date) AS start, max(date) AS "end", datediff(\'day\', min(date), max(date)) AS days FROM store_daily')


@query("gap_report", "store_id:string, gap_count:bigint, max_gap_days:int")
def q_gap_report(spark, sf_dir):
    return quality.gap_report(store_daily_of(spark, sf_dir), ["store_id"])


sql(
    "gap_report",
    BASE
    + """,
d AS (SELECT store_id, datediff('day', lag(date) OVER (PARTITION BY store_id ORDER BY date), date) AS diff
      FROM store_daily)
SELECT store_id, count(*) AS gap_count, max(diff) AS max_gap_days FROM d WHERE diff > 1 GROUP BY store_id""",
)


@query("date_gaps", "gap_after:date, date:date, gap_days:int")
def q_date_gaps(spark, sf_dir):
    return quality.gaps(T.promotions(spark, sf_dir))


sql(
    "date_gaps",
    with_ctes(PROMOTIONS)
    + """,
days AS (SELECT DISTINCT CAST(date AS DATE) AS date FROM promotions),
d AS (SELECT date, datediff('day', lag(date) OVER (ORDER BY date), date) AS gap_days FROM days)
SELECT CAST(date - CAST(gap_days AS INTEGER) AS DATE) AS gap_after, date, gap_days FROM d WHERE gap_days > 1""",
)


# --- V18 ------------------------------------------------------------------------------------
@query("validation_report", "section:string, column:string, metric:string, value:double@2")
def q_validation_report(spark, sf_dir):
    return quality.validation_report(store_daily_of(spark, sf_dir))


def _validation_sql() -> str:
    cols = [("date", "date"), ("store_id", "string"), ("has_discount", "double"), ("total_revenue", "double"),
            ("quantity_sold", "double"), ("profit", "double"), ("customer_traffic", "double"), ("is_holiday", "int")]
    num = [c for c, t in cols if t != "date" and t != "string"]
    parts = [
        "SELECT 'dataset' AS section, '*' AS column, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM store_daily",
        f"SELECT 'dataset', '*', 'columns', {float(len(cols))!r}",
        "SELECT 'schema', 'product_id', 'missing_column', 1.0",
        "SELECT 'schema', 'total_revenue', 'failed_conversion', "
        "CAST(count_if(total_revenue IS NOT NULL AND TRY_CAST(CAST(total_revenue AS VARCHAR) AS DOUBLE) IS NULL) AS DOUBLE) FROM store_daily",
        "SELECT 'schema', 'store_id', 'failed_conversion', 0.0",
        "SELECT 'schema', 'date', 'failed_conversion', "
        "CAST(count_if(date IS NOT NULL AND TRY_CAST(CAST(date AS VARCHAR) AS DATE) IS NULL) AS DOUBLE) FROM store_daily",
        "SELECT 'quality', '*', 'duplicate_rows', CAST(coalesce(sum(n - 1), 0) AS DOUBLE) FROM "
        "(SELECT count(*) AS n FROM store_daily GROUP BY ALL_COLS)",
    ]
    parts[-1] = parts[-1].replace("ALL_COLS", ", ".join(c for c, _ in cols))
    for c, t in cols:
        parts += [
            f"SELECT 'quality', '{c}', 'null_count', CAST(count_if({c} IS NULL) AS DOUBLE) FROM store_daily",
            f"SELECT 'quality', '{c}', 'null_percentage', count_if({c} IS NULL) * 100.0 / count(*) FROM store_daily",
            f"SELECT 'quality', '{c}', 'unique_values', CAST(count(DISTINCT {c}) AS DOUBLE) FROM store_daily",
        ]
        if c in num:
            x = f"CAST({c} AS DOUBLE)"
            parts += [f"SELECT 'quality', '{c}', '{m}', {f}({x}) FROM store_daily"
                      for m, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]
    for c in num:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT 'quality', '{c}', 'zscore_outliers', CAST(count_if(abs((s.{c} - m) / nullif(sd, 0)) > {ZSCORE_LIMIT}) AS DOUBLE) "
            f"FROM store_daily s, (SELECT avg({x}) AS m, stddev_samp({x}) AS sd FROM store_daily)"
        )
        parts.append(
            f"SELECT 'quality', '{c}', 'outliers', CAST(count_if({c} < q1 - {IQR_MULTIPLIER} * (q3 - q1) OR "
            f"{c} > q3 + {IQR_MULTIPLIER} * (q3 - q1)) AS DOUBLE) FROM store_daily, "
            f"(SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM store_daily)"
        )
    parts += [
        "SELECT 'time_series', 'date', 'start', CAST(datediff('day', DATE '1970-01-01', min(date)) AS DOUBLE) FROM store_daily",
        "SELECT 'time_series', 'date', 'end', CAST(datediff('day', DATE '1970-01-01', max(date)) AS DOUBLE) FROM store_daily",
        f"SELECT 'ranges', 'total_revenue', 'below_minimum', CAST(min(total_revenue) < {_lo!r} AS DOUBLE) FROM store_daily",
        f"SELECT 'ranges', 'total_revenue', 'above_maximum', CAST(max(total_revenue) > {_hi!r} AS DOUBLE) FROM store_daily",
        f"SELECT 'contract', 'total_revenue_ge_min', 'failed', CAST(count_if(total_revenue < {_lo!r}) AS DOUBLE) FROM store_daily",
        f"SELECT 'contract', 'total_revenue_le_max', 'failed', CAST(count_if(total_revenue > {_hi!r}) AS DOUBLE) FROM store_daily",
        *[f"SELECT 'contract', '{c}_type', 'failed', CAST(count_if({c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {t}) IS NULL) "
          "AS DOUBLE) FROM store_daily" for c, t in (("date", "DATE"), ("total_revenue", "DOUBLE"), ("store_id", "VARCHAR"))],
        *[f"SELECT 'group_gaps', store_id, '{m}', CAST({f} AS DOUBLE) FROM (SELECT store_id, datediff('day', lag(date) OVER "
          "(PARTITION BY store_id ORDER BY date), date) AS g FROM store_daily) WHERE g > 1 GROUP BY store_id"
          for m, f in (("gap_count", "count(*)"), ("max_gap_days", "max(g)"))],
        "SELECT 'time_series', 'date', 'days', CAST(datediff('day', min(date), max(date)) AS DOUBLE) FROM store_daily",
        "SELECT 'time_series', 'date', 'gap_count', CAST(count(*) AS DOUBLE) FROM "
        "(SELECT datediff('day', lag(date) OVER (ORDER BY date), date) AS g FROM (SELECT DISTINCT date FROM store_daily)) "
        "WHERE g > 1",
    ]
    return BASE + "\n" + "\nUNION ALL ".join(parts)


sql("validation_report", _validation_sql())
