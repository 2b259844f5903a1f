"""Chronological train / validation / test split by row position.

Row position in (date, key) order is computed without a global sort: rows
per date are counted, the small per-date table gets a running offset, and
each row adds its rank inside its date.  Only the per-date table (one row per
calendar day) passes through an ordered window; the big table is ranked
inside date partitions.  Sizes use the same float arithmetic as the
original: ``train = int(n·(1−test−val))``, ``val = int(n·val)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import TEST_SIZE, VALIDATION_SIZE


def split_fractions(test_size: float = TEST_SIZE, validation_size: float = VALIDATION_SIZE) -> tuple[float, float]:
    return 1 - test_size - validation_size, validation_size


def chronological_split(
    df: DataFrame,
    date_col: str = "date",
    order_cols: Sequence[str] = ("store_id",),
    test_size: float = TEST_SIZE,
    validation_size: float = VALIDATION_SIZE,
    target: str | None = None,
) -> DataFrame:
    """Adds ``position`` (0-based) and ``split`` ∈ {train, validation, test}.

    Rows with a NULL ``target`` are dropped after positions are assigned (P07).
    """
    per_date = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_date.select(date_col, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    n = per_date.agg(F.sum("_n")).scalar()
    train_frac, val_frac = split_fractions(test_size, validation_size)
    train_n = F.floor(n * F.lit(train_frac))
    val_n = F.floor(n * F.lit(val_frac))
    # one row per calendar day: a bounded table, safe to broadcast
    j = df.join(F.broadcast(offsets), date_col)
    inside = Window.partitionBy(date_col).orderBy(*order_cols)
    pos = F.col("_before") + F.row_number().over(inside) - 1
    out = j.withColumn("position", pos).withColumn(
        "split",
        F.when(F.col("position") < train_n, "train")
        .when(F.col("position") < train_n + val_n, "validation")
        .otherwise("test"),
    ).drop("_before")
    if target:
        out = out.dropna(subset=[target])
    return out


def split_sizes(split_df: DataFrame) -> DataFrame:
    """Rows per split (invariant: they sum to the input row count)."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def time_series_folds(df: DataFrame, folds: int = 5, date_col: str = "date") -> DataFrame:
    """Expanding-window folds over distinct dates.

    Dates are cut into ``folds + 1`` equal blocks by rank; fold k trains on
    blocks 0..k-1 and validates on block k.  Output: (date, fold, role).
    """
    days = df.select(date_col).distinct()
    # rank over distinct days only: one row per calendar day
    ranked = days.select(date_col, F.ntile(folds + 1).over(Window.orderBy(date_col)).alias("_block"))
    fold_ids = F.sequence(F.lit(1), F.lit(folds))
    exploded = ranked.select(date_col, "_block", F.explode(fold_ids).alias("fold"))
    return exploded.where(F.col("_block") <= F.col("fold") + 1).select(
        date_col, "fold",
        F.when(F.col("_block") <= F.col("fold"), "train").otherwise("validation").alias("role"),
    )
