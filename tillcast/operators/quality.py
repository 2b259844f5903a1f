"""Data-quality reports as DataFrames (long format, no driver dictionaries).

Each check is one aggregate pass (or a window for gaps); per-column
statistics are computed in a single ``agg`` over all columns and unpivoted
with ``stack`` into ``(column, metric, value)`` rows.  Outlier bounds are a
one-row aggregate consumed as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.config import (
    DATA_TYPES, DRIFT_STD_MULTIPLIER, IQR_MULTIPLIER, ISSUE_PREVIEW, REQUIRED_COLUMNS, VALUE_RANGES, ZSCORE_LIMIT,
)
from tillcast.operators.ordered import grouped_quantiles
from tillcast.session import written

NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def _numeric(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


# ---------------------------------------------------------------------------
# Schema-only checks (no job)
# ---------------------------------------------------------------------------
def missing_columns(spark: SparkSession, df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One issue row per required column absent from ``df``."""
    missing = [c for c in required if c not in df.columns]
    return spark.createDataFrame([(c, "missing_column") for c in missing], "column string, issue string")


# ---------------------------------------------------------------------------
# Per-partition (per-day file) checks
# ---------------------------------------------------------------------------
def partition_checks(df: DataFrame, part_col: str, negative_cols: Sequence[str]) -> DataFrame:
    """Rows and negative-value flags per partition (day file).

    A partition key present in ``df`` has rows; empty files simply have no
    rows, which :func:`empty_partitions` finds against an expected key list.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.bool_or(F.col(c) < 0).alias(f"negative_{c}") for c in negative_cols]
    return df.groupBy(part_col).agg(*aggs)


def empty_partitions(expected: DataFrame, df: DataFrame, part_col: str) -> DataFrame:
    """Expected partition keys without any row (anti join)."""
    return expected.select(part_col).distinct().join(df.select(part_col).distinct(), part_col, "left_anti")


def issue_rows(checks: DataFrame, part_col: str, negative_cols: Sequence[str]) -> DataFrame:
    """One issue row per (partition, failed check)."""
    exprs = [F.when(F.col(f"negative_{c}"), F.lit(f"negative_{c}")) for c in negative_cols]
    return checks.select(part_col, F.explode(F.array_compact(F.array(*exprs))).alias("issue"))


def issue_report(checks: DataFrame, issues: DataFrame, part_col: str, preview: int = ISSUE_PREVIEW) -> DataFrame:
    """Rows checked, issue count and the first issues (one-row summary)."""
    first = issues.orderBy(part_col, "issue").limit(preview)
    text = F.concat_ws(": ", F.col(part_col).cast("string"), "issue")
    listed = first.agg(F.concat_ws("; ", F.array_sort(F.collect_list(text)))).scalar()
    return checks.agg(F.sum("rows").alias("rows_checked")).select(
        "rows_checked",
        issues.agg(F.count(F.lit(1))).scalar().alias("issue_count"),
        listed.alias("first_issues"),
    )


# ---------------------------------------------------------------------------
# Type coercion
# ---------------------------------------------------------------------------
def type_check(df: DataFrame, data_types: Mapping[str, str] = DATA_TYPES) -> DataFrame:
    """Per configured column, actual type and the count of values that fail conversion."""
    cols = [c for c in data_types if c in df.columns]
    actual = dict(df.dtypes)
    aggs = [
        F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(data_types[c]).isNull()).alias(c)
        for c in cols
    ]
    counts = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{actual[c]}', '{data_types[c]}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(cols)}, {stack}) AS (column, actual_type, expected_type, failed)")


# ---------------------------------------------------------------------------
# Quality profile
# ---------------------------------------------------------------------------
def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (first kept)."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n")).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))


def repeated_rows(df: DataFrame) -> DataFrame:
    """V06 over every column of wide tables: as :func:`duplicate_rows`, without shuffling whole rows.

    Rows are reduced to a 64-bit fingerprint and counted; only rows whose
    fingerprint occurs again are compared by their values, so a collision
    costs a comparison and never a wrong count.  Equal NULLs, NaNs and zeros
    of either sign are equal, as in a grouping.  ``df`` is read twice.
    """
    marks = []
    for c, kind in df.dtypes:
        value = F.col(f"`{c}`")
        marks += [value + F.lit(0).cast(kind) if kind in ("float", "double") else value, value.isNull()]
    printed = df.select("*", F.xxhash64(*marks).alias("__fingerprint"))
    again = printed.groupBy("__fingerprint").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__fingerprint")
    return duplicate_rows(printed.join(again, "__fingerprint", "left_semi"))


def column_profile(df: DataFrame) -> DataFrame:
    """Null count/percentage, distinct count and numeric moments, long form.

    Moments and null counts are one aggregate.  Exact distinct counts come
    from the value counts of (column, value) pairs, which combine on the map
    side.  An empty table has no percentages.
    """
    num = set(_numeric(df))
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in df.columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"))
        if c in num:
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                     F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    row = df.agg(*aggs)
    items = []
    for c in df.columns:
        items += [f"'{c}', 'null_count', CAST(`{c}__nulls` AS DOUBLE)",
                  f"'{c}', 'null_percentage', try_divide(`{c}__nulls` * 100.0D, CAST(`__n` AS DOUBLE))"]
        if c in num:
            items += [f"'{c}', '{m}', `{c}__{m}`" for m in ("mean", "std", "min", "max")]
    stats = row.selectExpr(f"stack({len(items)}, {', '.join(items)}) AS (column, metric, value)")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in df.columns])
    values = df.select(F.explode(pairs).alias("_p")).select("_p.*").distinct()
    # columns without any value count 0
    unique = values.groupBy("column").agg(F.count("v").cast("double").alias("value"))
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")
    unique = names.join(unique, "column", "left").select(
        "column", F.lit("unique_values").alias("metric"), F.coalesce("value", F.lit(0.0)).alias("value"))
    return stats.unionByName(unique)


def outlier_counts(df: DataFrame, method: str = "iqr", cols: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column, values outside 1.5·IQR fences or with |z| > 3.

    Columns are stacked and reduced to value counts, which are written once:
    fences (exact quartiles per column, ``ordered.grouped_quantiles``) and the
    outliers both come from those.  z-scores use mean and standard deviation;
    a constant column has none, so no outliers.
    """
    cols = list(cols) if cols is not None else _numeric(df)
    if method not in ("iqr", "zscore"):
        raise ValueError(method)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])
    long = df.select(F.explode(pairs).alias("_p")).select("_p.*")
    if method == "iqr":
        long = written(long.where("v IS NOT NULL").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n")), "value-counts")
        iqr = F.col("q_1") - F.col("q_0")
        bounds = grouped_quantiles(long, ["column"], "v", [0.25, 0.75], "n").select(
            "column", (F.col("q_0") - IQR_MULTIPLIER * iqr).alias("lo"), (F.col("q_1") + IQR_MULTIPLIER * iqr).alias("hi"))
        out = F.sum(F.when((F.col("v") < F.col("lo")) | (F.col("v") > F.col("hi")), F.col("n")).otherwise(0))
    else:
        bounds = long.groupBy("column").agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"))
        out = F.count_if(F.abs(F.try_divide(F.col("v") - F.col("m"), F.col("s"))) > ZSCORE_LIMIT)
    # one row per column of a fixed list, so the bounds may be broadcast
    counts = long.join(F.broadcast(bounds), "column").groupBy("column").agg(out.alias("outliers"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(counts, "column", "left").select(
        "column", F.coalesce("outliers", F.lit(0)).cast("long").alias("outliers"), F.lit(method).alias("method"))


def range_breaches(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = VALUE_RANGES) -> DataFrame:
    """Configured min/max compared with the observed min/max."""
    cols = [c for c in ranges if c in df.columns]
    row = df.agg(*[F.min(c).alias(f"{c}__min") for c in cols], *[F.max(c).alias(f"{c}__max") for c in cols])
    items = []
    for c in cols:
        lo, hi = ranges[c]
        items += [f"'{c}', 'below_minimum', CAST(`{c}__min` AS DOUBLE), CAST({lo!r} AS DOUBLE), `{c}__min` < {lo!r}",
                  f"'{c}', 'above_maximum', CAST(`{c}__max` AS DOUBLE), CAST({hi!r} AS DOUBLE), `{c}__max` > {hi!r}"]
    return row.selectExpr(f"stack({len(items)}, {', '.join(items)}) AS (column, check, observed, bound, breached)")


def contract_rules(ranges: Mapping[str, tuple[float, float]] = VALUE_RANGES,
                   types: Mapping[str, str] | None = None) -> dict[str, Column]:
    """Row-level rules (nullable, of the given type, ≥ min, ≤ max) as boolean columns."""
    rules = {}
    for c, t in (types or {}).items():
        rules[f"{c}_type"] = F.col(c).isNull() | F.col(c).cast("string").try_cast(t).isNotNull()
    for c, (lo, hi) in ranges.items():
        rules[f"{c}_ge_min"] = F.col(c).isNull() | (F.col(c) >= lo)
        rules[f"{c}_le_max"] = F.col(c).isNull() | (F.col(c) <= hi)
    return rules


def contract_failures(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per (row key, failed rule)."""
    fails = F.array_compact(F.array(*[F.when(~cond, F.lit(name)) for name, cond in rules.items()]))
    return df.select("*", F.explode(fails).alias("failed_rule"))


def contract_summary(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Pass / fail counts per rule."""
    counts = df.agg(*[F.count_if(~cond).alias(name) for name, cond in rules.items()], F.count(F.lit(1)).alias("__n"))
    stack = ", ".join(f"'{n}', `{n}`, `__n` - `{n}`" for n in rules)
    return counts.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, failed, passed)")


# ---------------------------------------------------------------------------
# Time-series checks
# ---------------------------------------------------------------------------
def date_range(df: DataFrame, date_col: str = "date") -> DataFrame:
    """First day, last day and their distance in days."""
    d = F.to_date(date_col)
    return df.agg(F.min(d).alias("start"), F.max(d).alias("end")).withColumn("days", F.datediff("end", "start"))


def gap_report(df: DataFrame, group_cols: Sequence[str], date_col: str = "date") -> DataFrame:
    """Per group, gaps longer than one day, their count and the longest."""
    d = F.to_date(date_col)
    w = Window.partitionBy(*group_cols).orderBy("_d")
    diffs = df.select(*group_cols, d.alias("_d")).select(
        *group_cols, F.datediff("_d", F.lag("_d").over(w)).alias("diff")
    )
    return (
        diffs.where(F.col("diff") > 1)
        .groupBy(*group_cols)
        .agg(F.count(F.lit(1)).alias("gap_count"), F.max("diff").alias("max_gap_days"))
    )


def gaps(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Gaps of the whole table (over distinct dates): the day after which each gap starts.

    Dates are reduced to distinct days first; the ordering window then runs
    over at most one row per calendar day.
    """
    days = df.select(F.to_date(date_col).alias("date")).distinct()
    w = Window.orderBy("date")
    return (
        days.select("date", F.datediff("date", F.lag("date").over(w)).alias("gap_days"))
        .where(F.col("gap_days") > 1)
        .select(F.date_sub("date", F.col("gap_days")).alias("gap_after"), "date", "gap_days")
    )


# ---------------------------------------------------------------------------
# Drift and monitoring
# ---------------------------------------------------------------------------
def profile_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean and sample std per numeric column (long form), for V17."""
    cols = list(cols) if cols is not None else _numeric(df)
    row = df.agg(*[F.avg(c).alias(f"{c}__m") for c in cols], *[F.stddev_samp(c).alias(f"{c}__s") for c in cols])
    stack = ", ".join(f"'{c}', `{c}__m`, `{c}__s`" for c in cols)
    return row.selectExpr(f"stack({len(cols)}, {stack}) AS (column, mean, std)")


def distribution_shift(train_stats: DataFrame, current: DataFrame, k: float = DRIFT_STD_MULTIPLIER) -> DataFrame:
    """Columns whose current mean moved more than k·train std from the training mean."""
    cols = [c for c in _numeric(current)]
    now = profile_stats(current, cols).select("column", F.col("mean").alias("current_mean"))
    j = train_stats.select("column", F.col("mean").alias("train_mean"), F.col("std").alias("train_std")).join(
        now, "column"
    )
    return j.withColumn("shifted", F.abs(F.col("current_mean") - F.col("train_mean")) > k * F.col("train_std"))


# ---------------------------------------------------------------------------
# Combined report
# ---------------------------------------------------------------------------
def validation_report(df: DataFrame, date_col: str = "date", group_col: str = "store_id") -> DataFrame:
    """One long table (section, column, metric, value) from V05–V16; the input is written once for all parts.

    Dates are given as days since 1970-01-01; group_gaps has a row per
    series with gaps.
    """
    spark = df.sparkSession
    df = written(df, "validated")
    parts = [
        df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("dataset").alias("section"), F.lit("*").alias("column"), F.lit("rows").alias("metric"), "value"
        ),
        spark.range(1).select(F.lit("dataset").alias("section"), F.lit("*").alias("column"),
                              F.lit("columns").alias("metric"), F.lit(float(len(df.columns))).alias("value")),
        missing_columns(spark, df).select(F.lit("schema").alias("section"), "column", "issue", F.lit(1.0)),
        type_check(df).select(F.lit("schema").alias("section"), "column", F.lit("failed_conversion"),
                              F.col("failed").cast("double")),
        duplicate_rows(df).select(F.lit("quality").alias("section"), F.lit("*"), F.lit("duplicate_rows"),
                                  F.col("duplicate_rows").cast("double")),
        column_profile(df).select(F.lit("quality").alias("section"), "column", "metric", "value"),
        outlier_counts(df).select(F.lit("quality").alias("section"), "column", F.lit("outliers"),
                                  F.col("outliers").cast("double")),
        outlier_counts(df, "zscore").select(F.lit("quality").alias("section"), "column", F.lit("zscore_outliers"),
                                            F.col("outliers").cast("double")),
    ]
    if any(c in df.columns for c in VALUE_RANGES):
        parts.append(range_breaches(df).select(F.lit("ranges"), "column", "check", F.col("breached").cast("double")))
    rules = contract_rules({c: r for c, r in VALUE_RANGES.items() if c in df.columns},
                           {c: t for c, t in DATA_TYPES.items() if c in df.columns})
    if rules:
        parts.append(contract_summary(df, rules).select(F.lit("contract"), "rule", F.lit("failed"), F.col("failed").cast("double")))
    if date_col in df.columns:
        dr = date_range(df, date_col)
        days = f"stack(3, 'start', unix_date(start), 'end', unix_date(end), 'days', days) AS (metric, value)"
        parts.append(dr.selectExpr(days).select(F.lit("time_series"), F.lit(date_col), "metric", F.col("value").cast("double")))
        g = gaps(df, date_col)
        parts.append(g.agg(F.count(F.lit(1)).cast("double")).select(F.lit("time_series"), F.lit(date_col),
                                                                     F.lit("gap_count"), "*"))
        if group_col in df.columns:
            per = gap_report(df, [group_col], date_col)
            parts.append(per.select(F.lit("group_gaps"), F.col(group_col).cast("string"), F.lit("gap_count"),
                                    F.col("gap_count").cast("double")))
            parts.append(per.select(F.lit("group_gaps"), F.col(group_col).cast("string"), F.lit("max_gap_days"),
                                    F.col("max_gap_days").cast("double")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p.toDF(*out.columns))
    return out
