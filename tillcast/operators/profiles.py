"""Profiles of days that are kept and merged, so that a new day never re-reads the old ones.

A profile row describes one column on one day: exact counts and moments, and
two mergeable sketches.  Distinct counts come from a HyperLogLog sketch
(relative standard error about 0.8 %), quantiles and distribution functions
from a KLL sketch (rank error below 0.5 % at 99 % confidence); both have a
bounded size, whatever the number of rows.  Everything else is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: log2 of the registers of a distinct-count sketch, and the accuracy parameter of a quantile sketch.
HLL_BITS, KLL_K = 14, 800
#: Relative error of distinct counts (four standard errors) and rank error of quantiles that the tests allow.
DISTINCT_ERROR, RANK_ERROR = 0.035, 0.01


def _is_number(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")


def day_profiles(df: DataFrame, day: str | Column, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per day and column: ``day, column, rows, nulls, n, mean, m2, lo, hi, distinct, quantiles``.

    One aggregate over one scan; a day of any size is combined on the map side.
    ``n`` counts the numeric values that are neither NULL nor NaN, and ``mean``,
    ``m2`` (squared deviations), ``lo``, ``hi`` and ``quantiles`` describe them
    (NULL for a column that is no number).  NaN counts as one distinct value, a
    NULL day is a day of its own, and an empty table has no rows.  Quantile
    sketches sample at random: store them, since a second run gives others.
    """
    cols = list(cols) if cols is not None else df.columns
    kinds = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        value = F.col(f"`{c}`")
        text = F.concat(F.lit("="), value.cast("string"))  # the sketch passes over empty strings
        aggs += [F.count(value).alias(f"_present{i}"), F.hll_sketch_agg(text, F.lit(HLL_BITS)).alias(f"_distinct{i}")]
        if _is_number(kinds[c]):
            x = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
            aggs += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"_m2{i}"),
                     F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}"), F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias(f"_kll{i}")]
    by = (F.col(day) if isinstance(day, str) else day).alias("day")
    wide = df.groupBy(by).agg(*aggs)
    none, zero = F.lit(None).cast("double"), F.lit(0).cast("long")
    rows = []
    for i, c in enumerate(cols):
        num = _is_number(kinds[c])
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col("_rows").alias("rows"), (F.col("_rows") - F.col(f"_present{i}")).alias("nulls"),
            (F.col(f"_n{i}") if num else zero).alias("n"),
            *[(F.col(f"_{k}{i}") if num else none).alias(k) for k in ("mean", "m2", "lo", "hi")],
            F.col(f"_distinct{i}").alias("distinct"),
            (F.when(F.col(f"_n{i}") > 0, F.col(f"_kll{i}")) if num else F.lit(None).cast("binary")).alias("quantiles")))
    return wide.select("day", F.inline(F.array(*rows)))


def store_profiles(profiles: DataFrame, path: str) -> None:
    """Write profiles to a table by day; a day that comes again replaces its old profile, others stay."""
    profiles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def merged(profiles: DataFrame) -> DataFrame:
    """One row per column over all days of ``profiles``: ``column, rows, nulls, n, mean, std, lo, hi, distinct, quantiles``.

    Squared deviations are merged around the common mean, so nothing cancels;
    ``std`` is the sample's (NULL below two values).
    """
    of_column = Window.partitionBy("column")  # one row per day, not per input row
    total = F.sum("n").over(of_column)
    mean = F.try_divide(F.sum(F.col("mean") * F.col("n")).over(of_column), total)
    spread = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), F.lit(2.0))
    out = profiles.withColumn("_mean", mean).groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("n").alias("n"), F.first("_mean").alias("mean"),
        F.sum(spread).alias("_m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles", F.lit(KLL_K)).alias("quantiles"))
    return out.select(
        "column", "rows", "nulls", "n", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1))).alias("std"),
        "lo", "hi", "distinct", F.when(F.col("n") > 0, F.col("quantiles")).alias("quantiles"))


def distinct_count(sketch: str | Column = "distinct") -> Column:
    """Estimated distinct values of a profile's column (NULL is none)."""
    return F.hll_sketch_estimate(sketch)


def quantiles(probs: Sequence[float], sketch: str | Column = "quantiles") -> Column:
    """Array of estimated quantiles at ``probs``; NULL without values."""
    s = F.col(sketch) if isinstance(sketch, str) else sketch
    points = F.array(*[F.lit(float(p)) for p in probs])
    return F.when(s.isNotNull(), F.kll_sketch_get_quantile_double(s, points))


def drift(reference: DataFrame, current: DataFrame, steps: int = 200) -> DataFrame:
    """V17/V19 from two merged profiles: ``column, mean_shift, ks``; no row of either sample is read.

    ``mean_shift`` is the distance of the means in standard deviations of the
    reference (NULL if that is 0).  ``ks`` is the Kolmogorov–Smirnov distance of
    ``steps`` evenly spaced quantiles of either sample; it lies within 1/steps
    plus both rank errors of the exact statistic.
    """
    grid = [(i + 0.5) / steps for i in range(steps)]
    both = reference.select("column", F.col("mean").alias("_ma"), F.col("std").alias("_sa"), quantiles(grid).alias("_a")).join(
        current.select("column", F.col("mean").alias("_mb"), quantiles(grid).alias("_b")), "column")

    def share(side: str, x: Column) -> Column:
        return F.size(F.filter(side, lambda q: q <= x)) / steps

    gaps = F.transform(F.array_distinct(F.concat("_a", "_b")), lambda x: F.abs(share("_a", x) - share("_b", x)))
    return both.select("column", F.try_divide(F.abs(F.col("_mb") - F.col("_ma")), F.col("_sa")).alias("mean_shift"),
                       F.array_max(gaps).alias("ks"))
