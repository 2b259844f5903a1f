"""Phrase collocations from count streams in prefix and suffix order, merged in lockstep."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm import bytewords
from tillcast.llm.common import written

#: Bytes between words, and bytes that end a piece of text.
GAPS, ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"

#: Bits of the filter of frequent shorter phrases: 16 a phrase, within these powers of two (16 MB at most).
LEAST_BITS, MOST_BITS = 16, 27

#: Rows of a sorted stream that one task merges, and parts of a stream at most.
PART_ROWS, MOST_PARTS = 200_000, 4096

_MUL, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def _mixed(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all but its last word, and the last word's."""
    out = (state ^ word) * _MUL + _ADD
    return out ^ (out >> np.uint64(29))


# ---------------------------------------------------------------------------
# counting
# ---------------------------------------------------------------------------
def _place(state: np.ndarray, bits: int) -> np.ndarray:
    return (state * _MUL) >> np.uint64(64 - bits)


def phrase_counts(texts: DataFrame, order: int, shorter: Broadcast | None = None) -> DataFrame:
    """``lang, phrase, f``: occurrences of the phrases of ``order`` words in ``texts`` (lang, text).

    Order 1 also gives the empty phrase, whose count is the number of words.
    ``shorter`` is a filter (see ``phrase_filter``) that holds all phrases one
    word shorter that are frequent; a phrase is counted only where the filter
    holds both its first and its last ``order - 1`` words, so no frequent one
    is missed and what comes out is counted in full.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = bytewords.byte_classes(GAPS, ENDS)
        for batch in bytewords.grouped(batches):
            words = bytewords.cut(batch.column("text"), classes)
            langs = batch.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.row]
            spelling = words.spelling
            if order == 1:
                n = np.bincount(lang, minlength=len(langs.dictionary))
                blank = pa.array([""] * len(n), pa.large_string())
                yield pa.RecordBatch.from_arrays([langs.dictionary, blank, pa.array(n)], names=["lang", "phrase", "f"])
            at = np.flatnonzero(words.run[order - 1 :] == words.run[: len(words.run) - order + 1])
            if shorter is not None and len(at):
                table, bits = shorter.value
                word = np.array([_hash(w) for w in spelling.to_pylist()], dtype=np.uint64)[words.code]
                state = np.array([_hash(x) for x in langs.dictionary.to_pylist()], dtype=np.uint64)[lang]
                known = None  # for every place, whether the filter holds the phrase that begins there
                for k in range(order - 1):
                    state = _mixed(state[: len(word) - k], word[k:])
                bit = _place(state, bits)
                known = (table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                at = at[known[at] & known[at + 1]]
            code = lang[at] * len(spelling) + words.code[at]
            for k in range(1, order):
                code = np.unique(code, return_inverse=True)[1] * len(spelling) + words.code[at + k]
            _, first, f = np.unique(code, return_index=True, return_counts=True)
            first = at[first]
            parts = [spelling.take(pa.array(words.code[first + k])) for k in range(order)]
            phrase = parts[0] if order == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
            lang_names = langs.dictionary.take(pa.array(lang[first]))
            yield pa.RecordBatch.from_arrays([lang_names, phrase, pa.array(f.astype(np.int64))], names=["lang", "phrase", "f"])

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(1).cast(pa.string()), batch.column(2)], names=["lang", "phrase", "f"]
            )

    return texts.mapInArrow(plain, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def phrase_filter(phrases: DataFrame, count: int) -> Broadcast:
    """Bit table over the hashes of ``phrases`` (lang, phrase): 16 bits a phrase, 2 ** MOST_BITS at most.

    Where phrases outgrow that bound, the table lets more through, which costs
    counting and loses nothing.
    """
    bits = min(max(LEAST_BITS, (16 * count - 1).bit_length()), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                state = np.array([_hash(lang)], dtype=np.uint64)
                for word in phrase.split(" "):
                    state = _mixed(state, np.array([_hash(word)], dtype=np.uint64))
                found.append(state)
            bit = _place(np.concatenate(found), bits) if found else np.zeros(0, np.uint64)
            mask = (np.uint64(1) << (bit & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array(mask)], names=["at", "mask"])

    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    cells = phrases.select("lang", "phrase").mapInArrow(run, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask"))
    for batch in cells.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast((table, bits))


def frequent_phrases(docs: DataFrame, min_count: int, longest: int) -> tuple[DataFrame, int]:
    """``lang, words, f`` of all phrases of up to ``longest`` words found ``min_count`` times or more, and their number.

    The empty phrase of every language is there whatever its count.  One pass
    over the texts for each order; each leaves only frequent phrases behind.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    found, total, shorter = None, 0, None
    for order in range(1, longest + 1):
        enough = (F.col("f") >= min_count) | (F.col("phrase") == "")
        kept = written(phrase_counts(texts, order, shorter).filter(enough), f"phrases-{order}")
        if shorter is not None:
            shorter.unpersist()
        found = kept if found is None else found.unionByName(kept)
        real = kept.filter("phrase <> ''")
        count = real.count()
        total += count
        if not count:
            break
        if order < longest:
            shorter = phrase_filter(real, count)
    words = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " "))
    return found.select("lang", words.alias("words"), "f"), total


# ---------------------------------------------------------------------------
# lockstep scans
# ---------------------------------------------------------------------------
def _key(lang: str, words: list[str]) -> tuple:
    return lang.encode("utf-8", "surrogatepass"), [w.encode("utf-8", "surrogatepass") for w in words]


def _scan(rows: Iterator[tuple[str, list[str], int]], carried: list[tuple[str, list[str], int]]) -> Iterator[tuple]:
    """Rows of one sorted part with the counts of all their prefixes and whether a row one word longer has their count.

    ``carried`` are the prefixes of the part's first row, which lie in parts
    before; of those, only ones with such a longer row here come out, without
    prefix counts.  Holds one path of prefixes at a time.
    """
    path = [[lang, words, f, False, True] for lang, words, f in carried]

    def leave(entry: list, depth: int) -> Iterator[tuple]:
        lang, words, f, covered, foreign = entry
        if not foreign:
            yield lang, words, f, [p[2] for p in path[1:depth]], covered
        elif covered:
            yield lang, words, None, None, True

    for lang, words, f in rows:
        while path and not (path[-1][0] == lang and words[: len(path[-1][1])] == path[-1][1]):
            yield from leave(path[-1], len(path) - 1)
            path.pop()
        if path and path[-1][2] == f:
            path[-1][3] = True
        path.append([lang, words, f, False, False])
    while path:
        yield from leave(path[-1], len(path) - 1)
        path.pop()


def lockstep(stream: DataFrame, count: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``lang, words, f, heads, covered`` from the rows of ``stream`` (lang, words, f), which holds all their prefixes.

    ``heads`` are the counts of a row's proper prefixes of one word and more;
    ``covered`` tells that a row one word longer, with these words first, has
    the same count.  The stream is range-partitioned at sampled rows and
    sorted by words; each part is read once, in order, beside the prefixes of
    its first row.  ``heads`` is null in rows that only report ``covered``.
    """
    parts = min(MOST_PARTS, -(-max(count, 1) // part_rows))
    cuts: list[tuple[str, list[str]]] = []
    before: dict[tuple, int] = {}
    if parts > 1:
        some = stream.filter(F.size("words") > 0).orderBy(F.xxhash64("lang", "words")).limit(16 * parts)
        keys = sorted(((r.lang, list(r.words)) for r in some.select("lang", "words").collect()), key=lambda x: _key(*x))
        cuts = keys[len(keys) // parts :: max(1, len(keys) // parts)][: parts - 1]
        heads = {(lang, tuple(words[:k])) for lang, words in cuts for k in range(len(words))}
        wanted = stream.sparkSession.createDataFrame(
            [(lang, list(words)) for lang, words in heads], "lang string, words array<string>"
        )
        rows = stream.join(F.broadcast(wanted), ["lang", "words"]).select("lang", "words", "f").collect()
        before = {(r.lang, tuple(r.words)): r.f for r in rows}
    edges = [_key(*c) for c in cuts]

    @F.pandas_udf("int")
    def part_of(lang: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(edges, _key(x, list(w))) for x, w in zip(lang, words)], dtype="int32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("part", "lang", "words", "f")))

        def scanned() -> Iterator[tuple]:
            source = rows()
            held = next(source, None)
            while held is not None:
                part, following = held[0], [held]
                held = None

                def same() -> Iterator[tuple]:
                    nonlocal held
                    yield following[0][1:]
                    for row in source:
                        if row[0] != part:
                            held = row
                            return
                        yield row[1:]

                lang, words = cuts[part - 1] if part else ("", [])
                yield from _scan(same(), [(lang, words[:k], before[lang, tuple(words[:k])]) for k in range(len(words))])

        out = []
        for row in scanned():
            out.append(row)
            if len(out) == 1 << 14:
                yield _batch(out)
                out = []
        yield _batch(out)

    part = part_of("lang", "words") if cuts else F.lit(0)
    dealt = stream.select(part.alias("part"), "lang", "words", "f").repartitionByRange(parts, "part")
    ordered = dealt.sortWithinPartitions("part", "lang", "words")
    return ordered.mapInArrow(run, "lang string, words array<string>, f long, heads array<long>, covered boolean")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    kinds = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, kinds)], names=["lang", "words", "f", "heads", "covered"]
    )


# ---------------------------------------------------------------------------
# collocations
# ---------------------------------------------------------------------------
def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact for counts below 10 ** 16 (larger ones raise)."""
    a, n, left, right = (c.cast("decimal(16,0)") for c in (a, n, left, right))
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * a * n, left * right)


def collocations(docs: DataFrame, min_count: int = 100, longest: int = 5, part_rows: int = PART_ROWS) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every candidate phrase of ``docs`` (text, lang) that no longer one covers.

    Count streams of all orders are kept once in prefix order (by words) and
    once in suffix order (by words from the last one back).  One lockstep scan
    of each gives the counts of all first parts, of all last parts, and the
    extensions to the right and to the left with an equal count; no phrase is
    looked up by hash.  (An extension by more words with that count implies
    one by a single word, as counts never grow with length.)

    Null texts count as empty, null languages as ``und``.  Repeated rows count
    each time; ties between cuts go to the shortest first part.  An empty
    table gives an empty result; other columns are ignored.
    """
    stream, count = frequent_phrases(docs, min_count, longest)
    first = lockstep(stream, count, part_rows).select("lang", "words", "f", F.col("heads").alias("pre"), "covered")
    turned = stream.select("lang", F.reverse("words").alias("words"), "f")
    last = lockstep(turned, count, part_rows).select("lang", F.reverse("words").alias("words"), "f", F.col("heads").alias("suf"), "covered")
    both = first.unionByName(last, allowMissingColumns=True).filter(F.size("words") >= 2).groupBy("lang", "words").agg(
        F.max("f").alias("a"), F.max("pre").alias("pre"), F.max("suf").alias("suf"), F.bool_or("covered").alias("covered")
    )
    total = stream.filter(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    found = both.filter(~F.col("covered")).join(total, "lang")
    left = lambda k: F.element_at("pre", k)
    right = lambda k: F.element_at("suf", F.size("words") - k)
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda k: F.struct(
            _score(F.col("a"), F.col("n"), left(k), right(k)).alias("score"), k.alias("k"), left(k).alias("l"), right(k).alias("r")
        ),
    )
    cut = found.withColumn("cut", F.array_min(cuts))
    return cut.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")


def best(found: DataFrame, top: int, pools: int = 64) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``: score and a descending, phrase ascending.

    Ranked in ``pools`` parts of a language first, so that the task that ranks
    a language reads ``top * pools`` rows at most.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    pool = F.pmod(F.xxhash64("phrase"), F.lit(pools))
    pooled = found.withColumn("pool", pool)
    pooled = pooled.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "pool").orderBy(*order)))
    ranked = pooled.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long")).drop("pool")
