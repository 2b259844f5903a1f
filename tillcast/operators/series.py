"""Row positions, bounded windows and recursions along series of any length, without one task per series.

Rows are range-partitioned by (series, order) and written once, so a hot
series, or a table without a series key, is spread over many tasks.  What
looks a few rows back runs in blocks of rows that carry a halo of the rows
before; what needs the whole past is a scan of affine maps, whose blocks are
composed level by level.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators.ordered import _joined
from tillcast.session import written

#: Rows of a series in one block of a window, and of a scan.
BLOCK_ROWS, SCAN_ROWS = 65_536, 1024

#: Rows that a scan folds one after the other before it doubles.
FOLD_ROWS = 8


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "_pos") -> DataFrame:
    """Adds ``name``: 0-based place of the row in its series by ``order`` (nulls first; ties in a fixed order).

    The sorted table is written once; a series that lies in several parts gets
    an offset per part, from a table of one row per series and part.
    """
    by = [*keys, *order, "_tie"]
    ranged = df.withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(*by).sortWithinPartitions(*by)
    base = written(ranged.drop("_tie").withColumn("_id", F.monotonically_increasing_id()), "series")
    base = base.withColumn("_part", F.shiftright("_id", 33))
    counts = base.groupBy(*keys, "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return _joined(base, offsets, [*keys, "_part"]).select(*df.columns, (F.col("_id") + F.col("_shift")).alias(name))


def longest(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the longest series (one aggregate)."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def windowed(df: DataFrame, keys: Sequence[str], order: Sequence[str], build: Callable[[object, Column], list[Column]],
             halo: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with the columns ``build(window, place)``, where the window runs along each series.

    The expressions may look ``halo`` rows back at most; ``place`` is the row's
    0-based place in its series.  Series of up to ``block_rows`` rows are
    windows of their own.  Otherwise they are cut into blocks of ``block_rows``
    rows, and the last ``halo`` rows of a block are also dealt to the next one,
    so the result is the same and no window holds more than a block and a halo.
    """
    if halo > block_rows:
        raise ValueError("a block must hold the halo")
    if longest(df, keys) <= block_rows:
        whole = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(*order)
        return df.select(*df.columns, *build(whole, (F.row_number().over(whole) - 1).cast("long")))
    own = F.floor(F.col("_pos") / block_rows)
    also = F.col("_pos") % block_rows >= block_rows - halo
    dealt = positions(df, keys, order).withColumn("_own", own).withColumn(
        "_block", F.explode(F.when(also, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    w = Window.partitionBy(*keys, "_block").orderBy("_pos")
    found = dealt.select(*df.columns, "_own", "_block", *build(w, F.col("_pos")))
    return found.where("_own = _block").drop("_own", "_block")


def affine_scan(df: DataFrame, keys: Sequence[str], pos: str, maps: Sequence[tuple[str, str]], block_rows: int = SCAN_ROWS) -> DataFrame:
    """Replaces each pair of columns (a, c), the map y -> a·y + c of a row, by that of all rows of the series up to it.

    Inside a block, the maps of ``FOLD_ROWS`` rows are applied in sequence; then
    the map that ends k rows earlier is composed on, for k = 8, 16, 32, … (all
    in one window spec: one exchange and sort).  The maps
    of whole blocks are scanned the same way, and each block takes on the one
    before.  Products only shrink when |a| <= 1, so nothing overflows.
    """
    top = df.agg(F.max(pos)).first()[0]
    if top is None:
        return df
    inside = Window.partitionBy(*keys, "_block").orderBy(pos)
    out = df.withColumn("_block", F.floor(F.col(pos) / block_rows))
    new = {}
    for a, c in maps:
        whole, shift = F.lit(1.0), F.lit(0.0)
        for k in reversed(range(FOLD_ROWS)):
            row_a = F.col(a) if k == 0 else F.lag(a, k, 1.0).over(inside)
            row_c = F.col(c) if k == 0 else F.lag(c, k, 0.0).over(inside)
            whole, shift = row_a * whole, row_a * shift + row_c
        new[a], new[c] = whole, shift
    out = out.withColumns(new)
    step = FOLD_ROWS
    while step < min(block_rows, top + 1):
        new = {}
        for a, c in maps:
            before_a, before_c = F.lag(a, step).over(inside), F.lag(c, step).over(inside)
            new[a] = F.coalesce(F.col(a) * before_a, F.col(a))
            new[c] = F.coalesce(F.col(a) * before_c + F.col(c), F.col(c))
        out = out.withColumns(new)
        step *= 2
    if top < block_rows:
        return out.drop("_block")
    out = written(out, "scan")
    names = [x for pair in maps for x in pair]
    up = f"{pos}_up"  # the place of a block in its series
    ends = out.groupBy(*keys, F.col("_block").alias(up)).agg(F.max_by(F.struct(*names), pos).alias("_end")).select(*keys, up, "_end.*")
    past = affine_scan(ends, keys, up, maps, block_rows)
    past = past.select(*keys, (F.col(up) + 1).alias("_block"), *[F.col(x).alias(f"_past_{x}") for x in names])
    right = past.withColumnsRenamed({k: f"_k_{i}" for i, k in enumerate([*keys, "_block"])})
    on = [F.col(k).eqNullSafe(F.col(f"_k_{i}")) for i, k in enumerate([*keys, "_block"])]
    both = out.join(right, on, "left")
    new = {}
    for a, c in maps:
        new[c] = F.coalesce(F.col(a) * F.col(f"_past_{c}") + F.col(c), F.col(c))
        new[a] = F.coalesce(F.col(a) * F.col(f"_past_{a}"), F.col(a))
    return both.withColumns(new).select(*df.columns)


def last_observed(df: DataFrame, keys: Sequence[str], pos: str, observed: Column, block_rows: int = SCAN_ROWS) -> DataFrame:
    """Adds ``_seen``: place of the last row before this one where ``observed`` holds (null if there is none)."""
    hit = F.when(observed, F.col(pos))
    out = df.withColumn("_block", F.floor(F.col(pos) / block_rows))
    blocks = out.groupBy(*keys, "_block").agg(F.max(hit).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*keys, "_block", F.max("_last").over(earlier).alias("_carried"))
    inside = Window.partitionBy(*keys, "_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    both = _joined(out, carried, [*keys, "_block"])
    return both.withColumn("_seen", F.coalesce(F.max(hit).over(inside), F.col("_carried"))).drop("_block", "_carried")


def ewm(df: DataFrame, target: str, spans: Sequence[int], keys: Sequence[str], order: Sequence[str],
        block_rows: int = SCAN_ROWS) -> DataFrame:
    """Adds ``{target}_ewm_{span}``: exponentially weighted means over the whole past (``adjust=False``).

    y is the first value; then, with a = 2 / (span + 1) and w = (1 − a)^g for a
    value g rows after the one before, y = (w·y + a·x) / (w + a).  A NULL (or
    NaN) leaves y as it is; leading NULLs give NULL.  Each value is thus an
    affine map of y, and the means are a scan of those maps.  Every row keeps
    its place, rows of equal order too (in a fixed order among themselves).
    """
    x = F.nanvl(F.col(target).cast("double"), F.lit(None).cast("double"))
    placed = positions(df, keys, order).withColumn("_x", x)
    placed = last_observed(placed, keys, "_pos", F.col("_x").isNotNull(), block_rows)
    gap = (F.col("_pos") - F.col("_seen")).cast("double")
    maps = {}
    for s in spans:
        a = 2.0 / (s + 1.0)
        w = F.pow(F.lit(1.0 - a), gap)
        here, first = F.col("_x").isNotNull(), F.col("_seen").isNull()
        maps[f"_a{s}"] = F.when(~here, 1.0).when(first, 0.0).otherwise(w / (w + a))
        maps[f"_c{s}"] = F.when(~here, 0.0).when(first, F.col("_x")).otherwise(F.lit(a) * F.col("_x") / (w + a))
    started = F.col("_x").isNotNull() | F.col("_seen").isNotNull()
    mapped = written(placed.select(*df.columns, "_pos", started.alias("_started"), *[e.alias(n) for n, e in maps.items()]), "maps")
    scanned = affine_scan(mapped, keys, "_pos", [(f"_a{s}", f"_c{s}") for s in spans], block_rows)
    return scanned.select(*df.columns, *[F.when(F.col("_started"), F.col(f"_c{s}")).alias(f"{target}_ewm_{s}") for s in spans])
