"""File sources and sinks: day-partitioned Parquet, CSV history, snapshot and export writers.

Spark lists the files itself; partition columns (year/month/day) are
discovered and pruned by filters, so "the first N day files" becomes a date
filter and the default reads everything.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

HISTORY_SCHEMA = "date DATE, store_id STRING, total_revenue DOUBLE"


def read_day_partitioned(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Every day file under ``path`` (optionally one date range, pruned by partition)."""
    df = spark.read.parquet(path)
    if start or end:
        d = F.make_date("year", "month", "day") if {"year", "month", "day"} <= set(df.columns) else F.col("date")
        if start:
            df = df.where(d >= F.lit(start).cast("date"))
        if end:
            df = df.where(d <= F.lit(end).cast("date"))
    return df


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """Forecast input CSV (date, total_revenue required; store_id optional → ``store_001``)."""
    df = spark.read.csv(path, header=True, inferSchema=False)
    missing = {"date", "total_revenue"} - set(df.columns)
    if missing:
        raise ValueError(f"missing required columns: {sorted(missing)}")
    store = F.col("store_id") if "store_id" in df.columns else F.lit("store_001")
    return df.select(F.to_date("date").alias("date"), store.cast("string").alias("store_id"),
                     F.col("total_revenue").cast("double").alias("total_revenue"))


def read_history_checked(spark: SparkSession, path: str) -> DataFrame:
    """The same CSV read without failing: ``date, store_id, total_revenue, failed, record`` for every line.

    ``failed`` lists what is wrong with a line (empty: nothing): ``line`` (more
    or fewer fields than the header), ``date``, ``total_revenue`` (absent, no
    date, no finite number); such values are NULL.  ``record`` is the line as
    read, for failed ones.  All files under ``path`` have the first one's
    header.  Blank lines are no records; a file with a header alone gives none.
    """
    names = spark.read.csv(path, header=True, inferSchema=False).columns
    missing = {"date", "total_revenue"} - set(names)
    if missing:
        raise ValueError(f"missing required columns: {sorted(missing)}")
    broken = next(c for c in ("_corrupt_record", "_corrupt_record_") if c not in names)
    schema = StructType([StructField(c, StringType()) for c in [*names, broken]])
    raw = spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=broken)
    day, number = F.trim("date").try_cast("date"), F.trim("total_revenue").try_cast("double")
    number = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    failed = F.array_compact(F.array(
        F.when(F.col(broken).isNotNull(), F.lit("line")), F.when(day.isNull(), F.lit("date")),
        F.when(number.isNull(), F.lit("total_revenue"))))
    line = F.coalesce(F.col(broken), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])))
    store = F.col("store_id") if "store_id" in names else F.lit("store_001")
    return raw.select(day.alias("date"), store.alias("store_id"), number.alias("total_revenue"), failed.alias("failed"),
                      F.when(F.size(failed) > 0, line).alias("record"))


def _write_partitions(df: DataFrame, path: str, keys: list[str], mode: str) -> None:
    """Write by partition keys; overwriting replaces only the partitions that ``df`` holds.

    The rebalance hint gathers each partition's rows into few files, and
    splits a partition that is large.
    """
    (df.hint("rebalance", *keys).write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).parquet(path))


def write_partitioned_by_day(df: DataFrame, path: str, date_col: str = "date", mode: str = "overwrite") -> None:
    """Hive-style year=/month=/day= layout; days that ``df`` does not hold stay as they are."""
    days = (df.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))
              .withColumn("day", F.dayofmonth(date_col)))
    _write_partitions(days, path, ["year", "month", "day"], mode)


def write_weekly_snapshot(df: DataFrame, path: str, date_col: str = "date", mode: str = "overwrite") -> None:
    """Sunday rows only, partitioned by ISO year and ISO week (no January collisions)."""
    sundays = df.where(F.weekday(date_col) == 6)
    weeks = sundays.withColumn("year", F.expr(f"extract(YEAROFWEEK FROM {date_col})")).withColumn(
        "week", F.weekofyear(date_col))
    _write_partitions(weeks, path, ["year", "week"], mode)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S07."""
    df.write.mode(mode).parquet(path)


def export_csv(df: DataFrame, path: str, decimals: int = 2, mode: str = "overwrite") -> None:
    """Doubles rounded half-to-even, CSV with header (one file per task)."""
    cols = [F.bround(c, decimals).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    df.select(*cols).write.mode(mode).option("header", True).csv(path)


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """A report bundle — one Parquet directory per table under ``root``."""
    out = {}
    for name, df in tables.items():
        p = f"{root.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(p)
        out[name] = p
    return out
