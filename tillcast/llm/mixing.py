"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import packed, word_count, written

WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and how often a source (and a document) may be repeated.
TOTAL_SHARE, MAX_REPEATS = 1.5, 2
#: Documents that one slice of a source's shuffled order holds, about; slices of the finish-time axis.
SLICE_ROWS, TIME_SLICES = 1_000, 4096
_ORDER_BITS = 40


def _shuffle_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` per source of ``sizes`` (source, size).

    Sources by code point, null last, weigh ``WEIGHTS`` in turn and share
    ``TOTAL_SHARE`` of all words; no target exceeds ``MAX_REPEATS`` times its
    source's size, and what that cuts off goes to the others by weight.  The
    water level is found in closed form over the sources sorted by cap per
    weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = per.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(F.col("i") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    capped = numbered.withColumn("w", weigh).withColumn("cap", (F.col("source_size") * MAX_REPEATS).cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "i")
    upto, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    levels = capped.withColumns(
        {
            # the level if exactly the sources before this one are at their caps
            "level": (F.sum("source_size").over(everything) * TOTAL_SHARE - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
            / F.sum("w").over(after)
        }
    ).withColumn("level", F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(everything))
    return levels.select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target")
    )


def _placed(docs: DataFrame, size: Column) -> DataFrame:
    """Distinct ``doc_id, source, size`` with ``copies``, ``source_size``, ``target`` and the words ``ahead`` in its source."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.cast("long").alias("size")
    )
    groups = written(
        rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")).withColumn("key", _shuffle_key(F.col("doc_id"))),
        "queue-rows",
    )
    goals = written(targets(groups.select("source", (F.col("size") * F.col("copies")).alias("size"))), "targets")
    # words ahead of a row: sums over slices of its source's shuffled order, then a running sum inside its slice
    slices = max(1, groups.count() // SLICE_ROWS)
    at = F.floor(F.conv(F.substring("key", 1, 10), 16, 10).cast("long") * F.lit(slices) / F.lit(1 << _ORDER_BITS))
    sliced = groups.withColumns({"slice": at, "words": F.col("size") * F.col("copies")})
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = (
        sliced.groupBy("source", "slice")
        .agg(F.sum("words").alias("words"))
        .select(F.col("source").alias("s"), F.col("slice").alias("at"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = sliced.withColumn("upto", F.sum("words").over(inside))
    joined = upto.join(per_slice, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("at")))
    goals = goals.withColumnRenamed("source", "t")
    return joined.join(goals, F.col("source").eqNullSafe(F.col("t"))).select(
        "doc_id", "source", "size", "copies", "source_size", "target", (F.col("before") + F.col("upto") - F.col("words")).alias("ahead")
    )


def _last_finish(runs: DataFrame, budget: float) -> float:
    """Largest finish time up to which all places together stay within the budget (-1 if none does).

    The time axis is cut into slices; the slice in which the budget runs out
    is cut again until it holds a single time.  What is collected are sums
    per slice, ``TIME_SLICES`` + 1 at most.
    """
    low, high, served, last = 0.0, 1e300, 0, -1.0
    first = runs.agg(F.max("finish")).first()[0]
    if first is None:
        return last
    width = first / TIME_SLICES
    while True:
        here = runs.filter((F.col("finish") >= low) & (F.col("finish") <= high))
        at = F.floor((F.col("finish") - low) / width) if width > 0 else F.lit(0)
        sums = here.groupBy(at.alias("slice")).agg(F.sum("size").alias("words"), F.min("finish").alias("a"), F.max("finish").alias("b"))
        over = None
        for r in sorted(sums.collect()):
            if served + r.words > budget:
                over = r
                break
            served, last = served + r.words, r.b
        if over is None or over.a == over.b:
            return last
        low, high = over.a, over.b
        width = (high - low) / TIME_SLICES


def queue(docs: DataFrame, size: Column) -> DataFrame:
    """``doc_id, source, size, source_size, target, copy, times`` for every row of ``docs`` (columns doc_id, source).

    Each source's rows are shuffled by the hash of doc_id and queued
    ``MAX_REPEATS`` times over.  A place in the queue has the virtual finish
    time (words of its source up to its end) / target.  Places are served in
    the order of their finish times; service ends where the total of all
    targets would be passed (places with equal times are served together).
    ``times`` is how often the row is served.  Rows equal in doc_id, source
    and size stand one behind the other and are told apart by ``copy``.
    Null sources are a source; sources without words have target 0 and are
    not served; an empty table gives no rows.
    """
    placed = written(_placed(docs, size), "queued").select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    )
    end = F.col("ahead") + F.col("copy") * F.col("size")
    laps = [(F.lit(lap) * F.col("source_size") + end) / F.col("target") for lap in range(MAX_REPEATS)]
    live = placed.filter("target > 0")
    runs = live.select("size", F.explode(F.array(*laps)).alias("finish"))
    budget = placed.select("source", "target").distinct().agg(F.sum("target")).first()[0] or 0.0
    last = _last_finish(runs, budget * (1 + 1e-12))
    times = sum((F.when(x <= last, 1).otherwise(0) for x in laps), F.lit(0))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "copies", "copy", F.when(F.col("target") > 0, times).otherwise(0).alias("times")
    )


def mix(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, source and any others), each as often as the queue serves it, columns as they are."""
    rows = packed(docs).select(
        "row",
        F.col("row.doc_id").cast("long").alias("k_id"),
        F.col("row.source").cast("string").alias("k_source"),
        word_count(F.col("row.text")).alias("k_size"),
    )
    served = written(
        queue(docs, word_count(F.col("text"))).filter("times > 0").select("doc_id", "source", "size", "copies", "copy", "times"), "served"
    )
    on = (
        F.col("k_id").eqNullSafe(F.col("doc_id"))
        & F.col("k_source").eqNullSafe(F.col("source"))
        & (F.col("k_size") == F.col("size"))
    )
    taken = rows.join(served.filter("copies = 1"), on).select("row", "times")
    repeated = served.filter("copies > 1")
    if not repeated.isEmpty():
        # times never rises with copy, so how many copies are served at least t times tells what each row gets
        reach = repeated.groupBy("doc_id", "source", "size").agg(
            F.array(*[F.count(F.when(F.col("times") >= t, 1)) for t in range(1, MAX_REPEATS + 1)]).alias("reach")
        )
        whole = F.to_json("row")
        same = rows.join(reach, on, "left_semi").groupBy(
            "k_id", "k_source", "k_size", F.xxhash64(whole).alias("h1"), F.hash(whole).alias("h2")
        )
        same = written(same.agg(F.first("row").alias("row"), F.count("*").alias("n")), "repeated-rows")
        # numbers only, without texts: equal rows in the order of their hash take the copies one behind the other
        upto = Window.partitionBy("k_id", "k_source", "k_size").orderBy("h1", "h2").rowsBetween(Window.unboundedPreceding, 0)
        dealt = same.select("k_id", "k_source", "k_size", "h1", "h2", "n", (F.sum("n").over(upto) - F.col("n")).alias("start"))
        times = F.expr("aggregate(reach, 0L, (s, c) -> s + greatest(0L, least(n, c - start)))")
        dealt = dealt.join(reach, on).select("doc_id", "source", "size", "h1", "h2", times.cast("int").alias("times")).filter("times > 0")
        dealt = dealt.withColumnsRenamed({"h1": "d1", "h2": "d2"})
        taken = taken.union(same.join(dealt, on & (F.col("h1") == F.col("d1")) & (F.col("h2") == F.col("d2"))).select("row", "times"))
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
