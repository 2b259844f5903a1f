"""Encoders and scalers fitted as small aggregate tables.

Each fit is an aggregate (one row per category, or one row of moments) and
each transform a left join / column expression; nothing is collected to the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import TARGET_ENCODING_SMOOTHING
from tillcast.operators.ordered import label_index


def fit_label_encoder(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct labels → 0-based index (the table is one row per label)."""
    return label_index(df, col)


def apply_label_encoder(df: DataFrame, encoder: DataFrame, col: str, strict: bool = True) -> DataFrame:
    """Replace labels by index; unseen labels raise when ``strict`` (like a fitted encoder)."""
    out = df.join(encoder, col, "left")
    idx = F.col(f"{col}_index")
    if strict:
        idx = F.when(idx.isNull() & F.col(col).isNotNull(),
                     F.raise_error(F.concat(F.lit("unseen label: "), F.col(col)))).otherwise(idx)
    return out.withColumn(f"{col}_index", idx)


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population std per column (zero std → 1), long form (column, mean, std)."""
    row = train.agg(*[F.avg(c).alias(f"{c}__m") for c in cols], *[F.stddev_pop(c).alias(f"{c}__s") for c in cols])
    stack = ", ".join(f"'{c}', `{c}__m`, `{c}__s`" for c in cols)
    long = row.selectExpr(f"stack({len(cols)}, {stack}) AS (column, mean, std)")
    return long.withColumn("std", F.when((F.col("std") == 0) | F.col("std").isNull(), 1.0).otherwise(F.col("std")))


def apply_scaler(df: DataFrame, scaler: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x − mean) / std with the fitted moments (read as one scalar-subquery struct)."""
    m = scaler.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("mean", "std")))).alias("m")).scalar()
    return df.withColumns({c: (F.col(c) - m[c]["mean"]) / m[c]["std"] for c in cols})


def inverse_scale(df: DataFrame, col: str, mean: float, std: float) -> DataFrame:
    """x·std + mean."""
    return df.withColumn(col, F.col(col) * std + mean)


def fit_target_encoder(df: DataFrame, target: str, col: str, smoothing: float = TARGET_ENCODING_SMOOTHING) -> DataFrame:
    """(n·mean_c + s·global_mean) / (n + s) per category."""
    g = df.agg(F.avg(target)).scalar()
    per = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("category_mean"))
    return per.select(col, "n", "category_mean", g.alias("global_mean"),
                      ((F.col("n") * F.col("category_mean") + smoothing * g) / (F.col("n") + smoothing))
                      .alias(f"{col}_target_encoded"))


def apply_target_encoder(df: DataFrame, encoder: DataFrame, col: str) -> DataFrame:
    """Map categories; unseen ones get the global mean."""
    g = encoder.agg(F.first("global_mean")).scalar()
    enc = encoder.select(col, f"{col}_target_encoded")
    out = df.join(enc, col, "left")
    return out.withColumn(f"{col}_target_encoded", F.coalesce(F.col(f"{col}_target_encoded"), g))
