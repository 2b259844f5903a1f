"""Divergence of sources within a language, priced from joint tables of exact one-hot level products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm import bytewords
from tillcast.llm.common import written

#: Shares are counted in this unit.
UNIT = 1_000_000_000

#: Sources in a block of columns; terms in a block of rows, where counts (so levels) are few and where they are many.
GROUP_BLOCK = 64
BLOCK_ROWS, RARE_TOTAL = (4096, 512), 64

_CELL = "array<struct<g:int,c:bigint>>"


def _share(count: Column, words: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (words + terms)), exact."""
    scaled = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.call_function("div", scaled, (words + terms).cast("decimal(19,0)")) + 1


def _surprise(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q); shares are at most UNIT + 1, so squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def group_counts(texts: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of a term in a group, and documents with it.

    ``texts`` has lang, source and text without nulls.  Terms are maximal runs
    of ASCII letters (A-Z in lower case) and characters beyond ASCII.
    """
    gaps = bytes(b for b in range(128) if not chr(b).isalpha())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = bytewords.byte_classes(gaps)
        for batch in bytewords.grouped(batches):
            words = bytewords.cut(batch.column("text"), classes)
            if not len(words.code):
                continue
            lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(source.dictionary) + source.indices.to_numpy(
                zero_copy_only=False
            )
            size = len(words.spelling)
            pair, times = np.unique(words.row * size + words.code, return_counts=True)
            key, at = np.unique(group[pair // size] * size + pair % size, return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, at, times)
            of = key // size
            yield pa.RecordBatch.from_arrays(
                [
                    lang.dictionary.take(pa.array(of // len(source.dictionary))),
                    source.dictionary.take(pa.array(of % len(source.dictionary))),
                    words.spelling.take(pa.array(key % size)).cast(pa.string()),
                    pa.array(n),
                    pa.array(np.bincount(at)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    found = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def level_products(table: pa.Table, group_block: int = GROUP_BLOCK) -> list[tuple[int, int, int]]:
    """``(g, h, value)`` of all ordered pairs of sources of one block: terms in rows, (source, count level) in columns.

    ``table`` has a row per term, whose ``cells`` are its counts in the
    sources, and one row with ``base``, whose cells give every source of the
    block with its number of words plus terms.  The 0/1 columns of two sources,
    multiplied (in floats, exact below 2 ** 24 rows), are the joint table of
    their levels, level 0 included; each of its cells is priced both ways.
    """
    base = np.array(table.column("base").to_pylist(), dtype=bool)
    both = table.column("cells").to_pylist()
    sources = sorted((x["g"], x["c"]) for x in next(c for c, b in zip(both, base) if b))
    terms = [c for c, b in zip(both, base) if not b]
    row = np.repeat(np.arange(len(terms)), [len(c) for c in terms])
    g = np.array([x["g"] for c in terms for x in c], dtype=np.int64)
    count = np.array([x["c"] for c in terms for x in c], dtype=np.int64)
    columns, shares = {}, {}
    for source, whole in sources:
        mine = np.flatnonzero(g == source)
        levels, level = np.unique(count[mine], return_inverse=True)
        hot = np.zeros((len(terms), len(levels) + 1), dtype=np.float32)
        hot[:, 0] = 1
        hot[row[mine], 0] = 0
        hot[row[mine], level + 1] = 1
        columns[source] = hot
        shares[source] = np.array([1 + UNIT * (c + 1) // whole if whole else 1 for c in [0, *levels.tolist()]], dtype=np.int64)
    first, second = table.column("gi")[0].as_py(), table.column("gj")[0].as_py()
    out = []
    for a, _ in sources:
        for b, _ in sources:
            if a // group_block != first or b // group_block != second or (first == second and a >= b):
                continue
            joint = columns[a].T @ columns[b]
            i, j = np.nonzero(joint)
            n, p, q = joint[i, j].astype(np.int64), shares[a][i], shares[b][j]
            square = (p - q) ** 2
            out += [(a, b, int((n * (square // q)).sum())), (b, a, int((n * (square // p)).sum()))]
    return out


def _priced_blocks(terms: DataFrame, groups: DataFrame, group_block: int, block_rows: tuple[int, int]) -> DataFrame:
    """``lang, g, h, value`` summed over all blocks."""
    bucket = F.when(F.col("total") < RARE_TOTAL, F.floor(F.log2("total"))).otherwise(F.floor(F.log2("total")) + 100).cast("int")
    bucketed = terms.withColumn("bucket", bucket)
    rows = F.when(F.col("bucket") < 100, block_rows[0]).otherwise(block_rows[1])
    blocks = bucketed.groupBy("lang", "bucket").count().select("lang", "bucket", F.ceil(F.col("count") / rows).cast("int").alias("blocks"))
    lists = groups.groupBy("lang", F.floor(F.col("g") / group_block).cast("int").alias("i")).agg(
        F.collect_list(F.struct("g", (F.col("n") + F.col("v")).alias("c"))).cast(_CELL).alias("some")
    )
    one, other = lists.alias("one"), lists.alias("other")
    sides = one.join(other, (F.col("one.lang") == F.col("other.lang")) & (F.col("one.i") <= F.col("other.i"))).select(
        F.col("one.lang").alias("lang"), F.col("one.i").alias("gi"), F.col("other.i").alias("gj"),
        F.when(F.col("one.i") == F.col("other.i"), F.col("one.some")).otherwise(F.concat("one.some", "other.some")).alias("cells"),
    )
    places = blocks.select("lang", "bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    empty = groups.select("lang").distinct().select("lang", F.lit(-1).alias("bucket"), F.lit(0).alias("block"))
    bases = places.unionByName(empty).join(sides, "lang")
    pairs = sides.groupBy("lang").agg(F.collect_list(F.struct("gi", "gj")).alias("pairs"))
    placed = bucketed.join(blocks, ["lang", "bucket"]).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    dealt = placed.join(pairs, "lang").select("lang", "bucket", "block", "cells", F.explode("pairs").alias("p"))
    block_of = lambda x: F.floor(x["g"] / group_block)
    within = F.filter("cells", lambda x: (block_of(x) == F.col("p.gi")) | (block_of(x) == F.col("p.gj")))
    columns = ["lang", "bucket", "block", "gi", "gj"]
    dealt = dealt.select("lang", "bucket", "block", "p.gi", "p.gj", within.alias("cells"), F.lit(False).alias("base"))
    both = dealt.unionByName(bases.withColumn("base", F.lit(True)))

    def run(table: pa.Table) -> pa.Table:
        found = level_products(table, group_block)
        lang = table.column("lang")[0].as_py()
        return pa.table(
            {
                "lang": pa.array([lang] * len(found), pa.string()),
                "g": pa.array([x[0] for x in found], pa.int32()),
                "h": pa.array([x[1] for x in found], pa.int32()),
                "value": pa.array([x[2] for x in found], pa.int64()),
            }
        )

    priced = both.groupBy(*columns).applyInArrow(run, "lang string, g int, h int, value long")
    return priced.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    min_docs: int = 3,
    top_terms: int = 200,
    group_block: int = GROUP_BLOCK,
    block_rows: tuple[int, int] = BLOCK_ROWS,
    pools: int = 32,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how sources of ``docs`` (text, lang, source) differ within a language.

    ``pair`` rows price a source against every other one of its language over
    all kept terms (those in ``min_docs`` documents of the language), ``term``
    rows are the ``top_terms`` terms that stand out most from the language.

    Counts reach the blocks as one row per term; a hot source or word is one
    number there.  Pairs come from blocked products of 0/1 level columns (see
    ``level_products``), whose size is bounded by the block sizes.  Null text,
    lang and source count as empty; sources without terms take part with level
    0 alone; repeated rows count each time; equal values rank by item.  An
    empty table gives an empty result; other columns are ignored.
    """
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    by_lang = Window.partitionBy("lang").orderBy("source")
    numbered = written(
        texts.select("lang", "source").distinct().withColumn("g", (F.row_number().over(by_lang) - 1).cast("int")), "groups"
    )
    counted = group_counts(texts).join(numbered, ["lang", "source"])
    terms = written(
        counted.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("total"), F.sum("docs").alias("docs"),
            F.collect_list(F.struct("g", F.col("n").alias("c"))).cast(_CELL).alias("cells"),
        )
        .filter(F.col("docs") >= min_docs),
        "terms",
    )
    cells = terms.select("lang", "term", "total", F.inline("cells"))
    sizes = cells.groupBy("lang", "g").agg(F.sum("c").alias("n"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    groups = written(
        numbered.join(sizes, ["lang", "g"], "left").join(langs, "lang", "left").fillna(0, ["n", "v", "lang_n"]), "sized-groups"
    )

    named = groups.select("lang", "g", "source")
    items = groups.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))
    pairs = _priced_blocks(terms, groups, group_block, block_rows).join(named, ["lang", "g"]).join(items, ["lang", "h"])
    order = [F.desc("value"), F.asc("item")]
    ranked = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    )

    p, q = _share(F.col("c"), F.col("n"), F.col("v")), _share(F.col("total"), F.col("lang_n"), F.col("v"))
    priced = cells.join(groups, ["lang", "g"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    above = priced.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", _surprise(F.col("p"), F.col("q")).alias("value"))
    pooled = above.withColumn("pool", F.pmod(F.xxhash64("item"), F.lit(pools)))
    pooled = pooled.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "pool").orderBy(*order)))
    top = pooled.filter(F.col("rank") <= top_terms).drop("pool", "rank")
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return ranked.unionByName(top.filter(F.col("rank") <= top_terms)).withColumn("rank", F.col("rank").cast("int"))
