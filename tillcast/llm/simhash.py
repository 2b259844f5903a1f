"""SimHash near-duplicates by multi-index hashing over fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import packed, written
from tillcast.llm.graph import connected_components

BITS = 64
#: Candidate pairs of one segment value that are joined at once; larger values are split by further segments.
HOT_PAIRS = 4096
#: Values in a ball of bits that differ, at most, for splitting such values further.
MOST_FLIPS = 4096
_HASHED_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a UTF-8 text: a bit is set if it is set in over half the shingle hashes."""
    words = text.lower().split()  # on bytes: A-Z only, and exactly the six ASCII white spaces
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(grams), _HASHED_AT_ONCE):
        part = grams[at : at + _HASHED_AT_ONCE]
        hashes = np.fromiter(map(digest, part), dtype="<u8", count=len(part))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(grams), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` per row of ``docs`` (null text: empty, fingerprint 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps, pa.int64())],
                names=["doc_id", "text_hash", "fp"],
            )

    text = F.coalesce(F.col("text"), F.lit(""))
    src = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text")
    )
    return src.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _ball(places: list[int], radius: int) -> list[int]:
    """XOR masks that flip up to ``radius`` of the bits at ``places``."""
    return [sum(1 << b for b in some) for k in range(radius + 1) for some in combinations(places, k)]


def segments(number: int, max_distance: int) -> list[list[int]]:
    """Bit places of the segments for ``number`` fingerprints: as many as make probes and chance matches fewest."""

    def cost(m: int) -> float:
        width = BITS // m
        return m * sum(comb(width, k) for k in range(max_distance // m + 1)) * (1 + number / 2.0**width)

    m = min(range(1, 5), key=cost)
    cuts = [BITS * k // m for k in range(m + 1)]
    return [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]


def _radii(count: int, budget: int) -> list[int]:
    """Radii of ``count`` segments, of which one must hold if at most ``budget`` bits differ in all; -1: need not be looked at.

    Were more than these bits different in every segment, they would add up to
    more than ``budget``.
    """
    return [budget // count - (k > budget % count) for k in range(count)]


def links(distinct: DataFrame, max_distance: int = 2, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Pairs ``(u, v)``, u < v, of distinct fingerprints ``fp`` that differ in at most ``max_distance`` bits: all of them.

    Multi-index hashing: a table for each segment of the 64 bits holds the
    fingerprints by their value there.  Each fingerprint probes the tables with
    all values in a small Hamming ball around its own segment, fetches the
    matches and verifies the complete distance.

    A value with more than ``hot_pairs`` candidate pairs is not joined: its
    fingerprints go to tables by this and one more segment, with balls for the
    bits that are left to differ, and so on.  With all segments in the key an
    entry is a single fingerprint.  (For distances whose last balls would hold
    more than ``MOST_FLIPS`` values, splitting ends before them.)  No match is
    lost either way.
    """
    if max_distance == 0:
        return distinct.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    parts = segments(distinct.count(), max_distance)
    masks = [sum(1 << b for b in p) for p in parts]
    levels = next((k for k in range(len(parts), 0, -1) if comb(len(parts[0]), -(-max_distance // (len(parts) - k + 1))) <= MOST_FLIPS), 1)

    def free(k: int):
        """Whether segment ``k`` is not in the key yet."""
        return F.col("mask").bitwiseAND(F.lit(_signed(masks[k]))) == 0

    def tables(rows: DataFrame) -> DataFrame:
        """Entries (fp, mask) by one segment more."""
        more = [F.when(free(k), F.col("mask").bitwiseOR(F.lit(_signed(m)))) for k, m in enumerate(masks)]
        return rows.select("fp", F.explode(F.array_compact(F.array(*more))).alias("mask"))

    def probes(rows: DataFrame, level: int) -> DataFrame:
        """Probes (fp, alt, spent, mask): fingerprints with flips in one segment more, so far ``spent`` flips."""
        count, widest = len(parts) - level + 1, -(-max_distance // (len(parts) - level + 1))
        flips = F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(_signed(masks[k])).alias("m"), F.lit(_signed(flip)).alias("flip"), F.lit(flip.bit_count()).alias("n"))
            for k in range(len(parts)) for flip in _ball(parts[k], min(widest, max_distance))
        ])
        left = F.lit(max_distance) - F.col("spent")
        radii, seen = [], F.lit(0)
        for k in range(len(parts)):
            here = F.floor(left / count).cast("int") - F.when(seen > left % count, 1).otherwise(0)
            radii.append(F.when(free(k), here).otherwise(-1))
            seen = seen + F.when(free(k), 1).otherwise(0)
        dealt = rows.withColumn("radii", F.array(*radii)).select(
            "fp", "alt", "spent", "mask", F.explode(F.filter(flips, lambda b: b["n"] <= F.get("radii", b["k"]))).alias("b")
        )
        return dealt.select(
            "fp", F.col("alt").bitwiseXOR(F.col("b.flip")).alias("alt"), (F.col("b.n") + F.col("spent")).alias("spent"),
            F.col("mask").bitwiseOR(F.col("b.m")).alias("mask"),
        )

    start = distinct.select("fp", F.lit(0).cast("long").alias("mask"))
    entries = tables(start)
    asked = probes(start.withColumns({"alt": F.col("fp"), "spent": F.lit(0)}), 1)
    found = None
    for level in range(1, levels + 1):
        entries = entries.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        asked = asked.withColumn("value", F.col("alt").bitwiseAND(F.col("mask")))
        hot, cold_entries, cold_asked = None, entries, asked
        if level < levels:
            sizes = entries.groupBy("mask", "value").agg(F.count("*").alias("n"))
            wanted = asked.groupBy("mask", "value").agg(F.count("*").alias("k"))
            crowded = sizes.join(wanted, ["mask", "value"]).filter(F.col("n") * F.col("k") > hot_pairs)
            hot = written(crowded.select("mask", "value"), "hot-values")
            if hot.isEmpty():
                hot = None
            else:
                cold_entries = entries.join(hot, ["mask", "value"], "left_anti")
                cold_asked = asked.join(hot, ["mask", "value"], "left_anti")
        met = cold_asked.select("mask", "value", F.col("fp").alias("a")).join(
            cold_entries.select("mask", "value", F.col("fp").alias("b")), ["mask", "value"]
        )
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
        pairs = met.filter((F.col("a") != F.col("b")) & near)
        pairs = pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        found = pairs if found is None else found.unionByName(pairs)
        if hot is None:
            break
        hot_entries = written(entries.join(hot, ["mask", "value"], "left_semi").select("fp", "mask"), "hot-entries")
        hot_asked = written(asked.join(hot, ["mask", "value"], "left_semi").drop("value"), "hot-probes")
        # a fingerprint comes to a longer key from each of its parts
        entries, asked = tables(hot_entries).distinct(), probes(hot_asked, level + 1).distinct()
    return found.distinct()


def components(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, component_fp`` for every row of ``docs`` (columns ``doc_id``, ``text``).

    component_id is the smallest doc_id that chains of links reach, the row's
    own included (null only where a whole component has null ids);
    component_fp, the smallest linked fingerprint, names it in any case.  Exact
    copies meet as one fingerprint before any link is looked for.  Null and
    blank texts share fingerprint zero.  Repeated rows each come out; an
    empty table gives no rows; other columns are ignored.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fp")
    roots = connected_components(links(distinct.select("fp"), max_distance))
    linked = distinct.join(roots, distinct.fp == roots.node).select("fp", "root", "first_id")
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("low"))
    named = written(linked.join(lowest, "root").select("fp", "root", "low"), "component-of-fp")
    of_fp = written(
        distinct.join(named, "fp", "left").select(
            "fp", F.coalesce("low", "first_id").alias("component_id"), F.coalesce("root", "fp").alias("component_fp")
        ),
        "components",
    )
    return fps.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "component_id", "component_fp")


def dedupe(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """Keep one row of each component: that of the smallest doc_id (ties: smaller text hash), all columns as they are.

    Null ids sort last.  Rows equal in doc_id and text count as one document, of
    which one row stays.
    """
    found = components(docs, shingle, max_distance)
    chosen = written(
        found.groupBy("component_fp")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k"))
        .select("k.doc_id", "k.text_hash"),
        "survivors",
    )
    copies = (
        found.join(
            chosen.withColumnsRenamed({"doc_id": "c_id", "text_hash": "c_hash"}),
            F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")),
            "left_semi",
        )
        .groupBy("doc_id", "text_hash")
        .count()
    )
    copies = written(copies, "survivor-copies")
    rows = packed(docs).select(
        "row",
        F.col("row.doc_id").cast("long").alias("k_id"),
        F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))).alias("k_hash"),
    )

    def matching(keys: DataFrame) -> DataFrame:
        on = F.col("k_id").eqNullSafe(F.col("doc_id")) & (F.col("k_hash") == F.col("text_hash"))
        return rows.join(keys, on, "left_semi")

    out = matching(copies.filter("count = 1"))
    repeated = copies.filter("count > 1")
    if not repeated.isEmpty():
        out = out.union(matching(repeated).dropDuplicates(["k_id", "k_hash"]))
    return out.select("row.*")
