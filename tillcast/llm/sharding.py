"""Sharding documents by extendible hashing: a directory of hash prefixes, split where a shard is too large."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import written

#: Byte limit of a shard.
SHARD_BYTES = 8 << 20
HASH_BITS, MAX_STEP = 60, 16


def hash_bits(doc_id: Column) -> Column:
    """First ``HASH_BITS`` bits of the MD5 of the id's text, as a string of 0 and 1 (null: the text ``null``)."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    return F.lpad(F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 2), HASH_BITS, "0")


def directory(sizes: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``prefix, bytes, rows`` of every shard for ``sizes`` (bits, bytes, rows).

    Starts from one shard.  A shard over the limit is split on its next bit,
    and only such shards are; an entry of the directory is thus as short as
    the limit allows.  Several bits are looked at in one pass: bytes are
    summed for every prefix in reach, and a shard ends at the shortest
    prefix within the limit.  A prefix of all ``HASH_BITS`` bits ends in any
    case (equal ids; see ``shards``).
    """
    done, prefix_length, live = None, 0, sizes
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    step = min(MAX_STEP, max(1, math.ceil(math.log2(max(2, 2 * total / limit)))))
    while True:
        end = min(HASH_BITS, prefix_length + step)
        cells = written(
            live.groupBy(F.substring("bits", 1, end).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")),
            "cells",
        )
        # the first pass also tries the empty prefix; later ones begin below what is known to be too large
        depths = F.sequence(F.lit(0 if done is None else prefix_length + 1), F.lit(end))
        sums = (
            cells.select(F.explode(depths).alias("depth"), "cell", "bytes", "rows")
            .groupBy("depth", F.substring(F.col("cell"), F.lit(1), F.col("depth")).alias("prefix"))
            .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        )
        fits = sums.filter((F.col("bytes") <= limit) | (F.col("depth") == HASH_BITS)).select("prefix", "bytes", "rows", "depth")
        # a fitting prefix is a shard if the prefix one bit shorter does not fit
        parents = fits.select(F.col("prefix").alias("p"), F.col("depth").alias("d"))
        ends = written(
            fits.join(
                parents,
                (F.col("d") == F.col("depth") - 1) & (F.col("p") == F.expr("substring(prefix, 1, depth - 1)")),
                "left_anti",
            ).select("prefix", "bytes", "rows"),
            "directory",
        )
        done = ends if done is None else done.union(ends)
        if end == HASH_BITS:
            return done
        full = cells.filter(F.col("bytes") > limit).select("cell")
        if full.isEmpty():
            return done
        live = live.join(full, F.substring("bits", 1, end) == F.col("cell"), "left_semi")
        prefix_length, step = end, min(MAX_STEP, 8)


def plain_bytes(docs: DataFrame) -> Column:
    """Bytes of a row with all its columns, as Parquet stores them plainly."""

    def of(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 4
        nested = kind.startswith(("array", "map", "struct"))
        return F.octet_length(F.to_json(F.struct(c))) if nested else F.lit(16 if kind.startswith("decimal") else 8)

    return sum((of(c, t).cast("long") for c, t in docs.dtypes), F.lit(0).cast("long"))


def shards(docs: DataFrame, size: Column | None = None, limit: int = SHARD_BYTES) -> DataFrame:
    """``row, doc_id, bytes, shard, part, shard_bytes, shard_rows`` for every row of ``docs`` (column doc_id).

    row: the document with all its columns.  size: its bytes, by default
    those of all columns (``plain_bytes``).  shard: the hash prefix (bits as
    text, empty for a single shard); part: 0, but where rows with one id
    alone exceed the limit no bit can part them, and they go to parts 0, 1,
    2, ... in their order of size, each within the limit.  shard_bytes and
    shard_rows belong to the shard's part.  Only a single document over the
    limit makes a larger shard, alone.  Null sizes count 0; repeated rows
    each come out; an empty table gives no rows.  A shard's part is in one
    partition, so that it is written as one file.
    """
    size = plain_bytes(docs) if size is None else size
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(
        whole, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(size.cast("long"), F.lit(0)).alias("bytes")
    )
    # equal sizes of one id travel as one with a count; texts move only once their shard is known
    groups = written(
        rows.groupBy("doc_id", "bytes").agg(F.count("*").alias("copies")).withColumn("bits", hash_bits(F.col("doc_id"))), "sizes"
    )
    ends = directory(groups.select("bits", (F.col("bytes") * F.col("copies")).alias("bytes"), F.col("copies").alias("rows")), limit)
    ends = written(ends.withColumn("depth", F.length("prefix")), "shards")
    over = ends.filter((F.col("bytes") > limit) & (F.col("rows") > 1)).select(F.col("prefix").alias("bits"))
    has_over = not over.isEmpty()
    rows = rows.withColumn("bits", hash_bits(F.col("doc_id")))
    fine = rows.join(over, "bits", "left_anti") if has_over else rows
    # rows are dealt by the bits that all shards have; the few shards below such a cell are told apart in place
    least = ends.agg(F.min("depth")).first()[0] or 0
    cells = ends.groupBy(F.substring("prefix", 1, least).alias("c")).agg(
        F.collect_list(F.struct("prefix", "bytes", "rows")).alias("entries")
    )
    dealt = fine.withColumn("cell", F.substring("bits", 1, least)).repartition("cell")
    found = dealt.join(cells, F.col("cell") == F.col("c")).withColumn("end", F.expr("filter(entries, e -> startswith(bits, e.prefix))[0]"))
    out = found.select(
        "row", "doc_id", "bytes", F.col("end.prefix").alias("shard"), F.lit(0).cast("long").alias("part"),
        F.col("end.bytes").alias("shard_bytes"), F.col("end.rows").alias("shard_rows"),
    )
    return out.unionByName(_parts(rows.join(over, "bits", "left_semi"), limit)) if has_over else out


def _parts(rows: DataFrame, limit: int) -> DataFrame:
    """What ``shards`` returns, for rows ``row, doc_id, bytes, bits`` whose equal bits exceed the limit.

    Each group of rows equal in id and size fills parts of its own.  Rows are
    numbered within the tasks that wrote them, and tasks' counts are summed
    up, so a group is never in one task.
    """
    kept = written(rows.withColumns({"task": F.spark_partition_id(), "uid": F.monotonically_increasing_id()}), "large-ids")
    key = ["bits", "doc_id", "bytes"]
    tasks = kept.groupBy(*key, "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*key).orderBy("task")
    groups = tasks.groupBy(*key).agg(F.sum("n").alias("copies"))
    per_part = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("bytes"), F.lit(1)))).cast("long")
    n_parts = F.ceil(F.col("copies") / F.col("per_part"))
    order = Window.partitionBy("bits").orderBy("bytes", F.asc_nulls_first("doc_id")).rowsBetween(Window.unboundedPreceding, 0)
    groups = groups.withColumn("per_part", per_part).withColumn("first_part", F.sum(n_parts).over(order) - n_parts)
    laid = tasks.withColumn("ahead", F.sum("n").over(before) - F.col("n")).select(
        F.col("bits").alias("b"), F.col("doc_id").alias("i"), F.col("bytes").alias("s"), F.col("task").alias("t"), "ahead"
    )
    laid = laid.join(groups, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("s") == F.col("bytes")) & (F.col("b") == F.col("bits"))).drop(*key)
    numbered = kept.withColumn("k", F.row_number().over(Window.partitionBy("task", *key).orderBy("uid")) - 1)
    on = (F.col("task") == F.col("t")) & (F.col("bits") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("bytes") == F.col("s"))
    k = F.floor((F.col("ahead") + F.col("k")) / F.col("per_part"))
    placed = numbered.join(laid, on).withColumn("nth", k)
    in_part = F.least(F.col("per_part"), F.col("copies") - F.col("nth") * F.col("per_part")).cast("long")
    return placed.select(
        "row", "doc_id", "bytes", F.col("bits").alias("shard"), (F.col("first_part") + F.col("nth")).cast("long").alias("part"),
        (in_part * F.col("bytes")).alias("shard_bytes"), in_part.alias("shard_rows"),
    ).repartition("shard", "part")


def write_shards(docs: DataFrame, size: Column | None = None, limit: int = SHARD_BYTES) -> DataFrame:
    """Writes each shard's documents to files of their own in the shared folder; returns what was written.

    Columns as of ``shards`` and ``place`` (shard and part), which names a
    shard's folder.
    """
    placed = shards(docs, size, limit).withColumn("place", F.concat(F.lit("s"), "shard", F.lit("-"), F.col("part").cast("string")))
    return written(placed, "sharded", by="place")
