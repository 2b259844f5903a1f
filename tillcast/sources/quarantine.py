"""Row checks while data come in: good rows, failed rows and counts from one pass."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass
class Ingested:
    """What :func:`ingest` leaves: two tables and the rules' counts."""

    good: DataFrame
    failed: DataFrame
    counts: DataFrame


def checked(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``failed_rules``, the names of the rules a row breaks in their given order (a NULL verdict breaks none)."""
    if "failed_rules" in df.columns or "passed" in df.columns:
        raise ValueError("the input has a column named failed_rules or passed")
    broken = [F.when(~cond, F.lit(name)) for name, cond in rules.items()]
    none = F.array().cast("array<string>")
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken)) if broken else none)


def ingest(df: DataFrame, rules: Mapping[str, Column], path: str) -> Ingested:
    """Write ``df`` under ``path`` in one pass, rows that break a rule apart from the others.

    The rows go to the subfolders ``passed=true`` and ``passed=false`` with the
    rules they break; ``counts`` (``rule, failed, passed``) is observed while
    they are written, so the input is scanned once and never shuffled.  Good
    rows come back with the input's columns, failed ones with ``failed_rules``
    too; together they are the input.  An empty input leaves empty tables and
    counts of 0.  A folder that exists raises.
    """
    spark = df.sparkSession
    rows = checked(df, rules)
    seen = Observation()
    held = [F.count_if(F.array_contains("failed_rules", name)).alias(f"f{i}") for i, name in enumerate(rules)]
    marked = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *held)
    marked.withColumn("passed", F.size("failed_rules") == 0).write.partitionBy("passed").parquet(path)
    found = seen.get  # one number per rule
    counts = [(name, found.get(f"f{i}") or 0, (found.get("rows") or 0) - (found.get(f"f{i}") or 0)) for i, name in enumerate(rules)]
    schema = rows.withColumn("passed", F.lit(True)).schema
    back = spark.read.schema(schema).parquet(path)
    return Ingested(
        back.where("passed").select(*[F.col(f"`{c}`") for c in df.columns]),
        back.where("NOT passed").drop("passed"),
        spark.createDataFrame(counts, "rule string, failed bigint, passed bigint"))
