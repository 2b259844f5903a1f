"""Running totals, ranks and exact quantiles per group in value order, without one task per group.

Each group's rows are cut into value ranges (boundaries from a bounded
quantile sketch per group).  Sums per range get running offsets (a few rows
per group), and each range adds its own running sum.  A group that holds most
of the rows is thus spread over many tasks, and everything stays in the plan:
nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Value ranges per group; a power of two, since a row's range is found by halving.
RANGES = 256


def _ranged(df: DataFrame, group_cols: Sequence[str], order_col: str) -> DataFrame:
    """``df`` with the range ``_b`` of its row's value in its group; null values come first.

    The range is the number of sorted bounds below the value.  Each halving is
    a projection of its own, so that all run in compiled code; lambda functions
    over the bounds would be interpreted for each row.
    """
    probs = [i / RANGES for i in range(1, RANGES)]
    key = F.col(order_col).cast("double")
    sketch = F.array_distinct(F.sort_array(F.percentile_approx(key, probs, 2000)))
    bounds = df.groupBy(*group_cols).agg(sketch.alias("_bounds"))
    out = _joined(df, bounds, group_cols).withColumn("_b", F.lit(0))
    step = RANGES // 2
    while step:
        # a null value, and a place beyond the last bound, compare as null
        below = F.get("_bounds", F.col("_b") + (step - 1)) < key
        out = out.withColumn("_b", F.when(below, F.col("_b") + step).otherwise(F.col("_b")))
        step //= 2
    return out.drop("_bounds")


def _joined(df: DataFrame, per_group: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """``df`` with the columns of a one-row-per-group table (null keys match)."""
    if not group_cols:
        return df.crossJoin(per_group)  # one row
    right = per_group.withColumnsRenamed({g: f"_g{i}" for i, g in enumerate(group_cols)})
    on = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group_cols)]
    return df.join(right, on).drop(*[f"_g{i}" for i in range(len(group_cols))])


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str], group_cols: Sequence[str] = (),
                   tie_cols: Sequence[str] = ()) -> DataFrame:
    """Adds ``cum_{c}``: the sum of c over the group's rows up to the row, by (``order_col``, ``tie_cols``).

    The order must be unique within a group.
    """
    groups = list(group_cols)
    r = _ranged(df, groups, order_col)
    totals = r.groupBy(*groups, "_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *groups, "_b", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols]
    )
    inside = Window.partitionBy(*groups, "_b").orderBy(order_col, *tie_cols).rowsBetween(Window.unboundedPreceding, 0)
    cum = r.select("*", *[F.sum(c).over(inside).alias(f"_i_{c}") for c in sum_cols])
    return _joined(cum, offsets, [*groups, "_b"]).select(
        *df.columns, *[(F.col(f"_o_{c}") + F.col(f"_i_{c}")).alias(f"cum_{c}") for c in sum_cols]
    )


def ranks(df: DataFrame, group_cols: Sequence[str], order_col: str, tie_cols: Sequence[str]) -> DataFrame:
    """Adds ``rank`` (from 1) of the row in its group by (``order_col``, ``tie_cols``) and the group's size ``n``."""
    groups = list(group_cols)
    one = df.withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(one, order_col, ["_one"], groups, tie_cols).withColumnRenamed("cum__one", "rank").drop("_one")
    return _joined(ranked, df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")), groups)


def label_index(labels: DataFrame, col: str) -> DataFrame:
    """``col, {col}_index``: 0-based rank of each distinct label, for any number of labels.

    Labels are range-partitioned and written once; each partition's index
    starts at the number of labels before it.
    """
    from tillcast.session import written

    ranged = labels.select(col).where(F.col(col).isNotNull()).distinct().repartitionByRange(col)
    ranged = written(ranged.withColumn("_part", F.spark_partition_id()), "labels")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("_part").orderBy(col)
    return ranged.withColumn("_r", F.row_number().over(inside)).join(offsets, "_part").select(
        col, (F.col("_o") + F.col("_r") - 1).cast("int").alias(f"{col}_index"))


def ks_statistics(df: DataFrame, in_a: Column, in_b: Column, cols: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov statistic D = max |F_a − F_b| of each column (V19): ``column, ks``.

    The samples are the rows for which ``in_a`` and ``in_b`` hold.  All columns
    go through one plan: one scan reduces them to value counts per column and
    sample, these are written once, and the empirical CDFs come from one
    grouped :func:`running_totals`.  NULL where a sample has no value.
    """
    from tillcast.session import written

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])
    sides = df.select(F.coalesce(in_a, F.lit(False)).cast("long").alias("na"),
                      F.coalesce(in_b, F.lit(False)).cast("long").alias("nb"), F.explode(pairs).alias("_p"))
    counts = sides.select("_p.*", "na", "nb").where("v IS NOT NULL AND na + nb > 0").groupBy("column", "v").agg(
        F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    counts = written(counts, "value-counts")
    totals = counts.groupBy("column").agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))
    cum = _joined(running_totals(counts, "v", ["na", "nb"], ["column"]), totals, ["column"])
    gap = F.abs(F.try_divide("cum_na", "ta") - F.try_divide("cum_nb", "tb"))
    found = cum.groupBy("column").agg(F.max(gap).alias("ks"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(found, "column", "left")


def ks_statistic(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """:func:`ks_statistics` of one column of two tables: one row ``ks`` (NULL if a sample is empty)."""
    both = a.select(col, F.lit(True).alias("_a")).unionByName(b.select(col, F.lit(False).alias("_a")))
    return ks_statistics(both, F.col("_a"), ~F.col("_a"), [col]).select("ks")


def grouped_quantiles(df: DataFrame, group_cols: Sequence[str], col: str, probs: Sequence[float],
                      weight: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles of ``col`` per group, one column ``q_{i}`` per probability.

    Values are reduced to (value, count) pairs — a hot value is one row —
    and these are counted by value range.  Only the ranges that hold a wanted
    rank are put in order, and their cumulative counts begin at the count of
    the ranges below.  The value at 0-based rank k is the smallest value whose
    cumulative count exceeds k; quantile p interpolates between ranks
    ⌊p(N−1)⌋ and ⌈p(N−1)⌉.  Rows with a NULL value are ignored; ``weight``
    gives integer row weights.
    """
    groups = list(group_cols)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    vc = (df.where(F.col(col).isNotNull()).groupBy(*groups, F.col(col).cast("double").alias("_v"))
            .agg(F.sum(w).alias("_n")).where(F.col("_n") > 0))
    places = [(F.col("_total") - 1) * F.lit(float(p)) for p in probs]
    ranged = _ranged(vc, groups, "_v")
    of_group = Window.partitionBy(*groups)
    upto = of_group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    # at most RANGES rows per group
    sums = ranged.groupBy(*groups, "_b").agg(F.sum("_n").alias("_t")).select(
        *groups, "_b", (F.sum("_t").over(upto) - F.col("_t")).alias("_o"), F.sum("_t").over(upto).alias("_upto"),
        F.sum("_t").over(of_group).alias("_total"))
    wanted = F.lit(False)
    for pos in places:
        for k in (F.floor(pos), F.ceil(pos)):
            wanted = wanted | ((k >= F.col("_o")) & (k < F.col("_upto")))
    held = _joined(ranged, sums.where(wanted).drop("_upto"), [*groups, "_b"])
    inside = Window.partitionBy(*groups, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cum = held.withColumn("cum__n", F.col("_o") + F.sum("_n").over(inside))
    aggs = []
    for i, pos in enumerate(places):
        v_lo = F.min(F.when(F.col("cum__n") > F.floor(pos), F.col("_v")))
        v_hi = F.min(F.when(F.col("cum__n") > F.ceil(pos), F.col("_v")))
        share = F.max(pos - F.floor(pos))
        aggs.append((v_lo + (v_hi - v_lo) * share).alias(f"q_{i}"))
    return cum.groupBy(*groups).agg(*aggs)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], weight: str | None = None) -> DataFrame:
    """:func:`grouped_quantiles` of the whole table: one row (NULLs for an empty one)."""
    return grouped_quantiles(df, (), col, probs, weight)
