"""Rule filter: how far a document's character classes and common words diverge from its language's reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import WORD_SPACE, word_array, written

#: Common words kept per language.
COMMON_WORDS = 24
#: Weight of a document in its language's word shares, dealt to its words in whole numbers (sums are exact in any order).
DOCUMENT_WEIGHT = 100_000_000
#: Documents, none of them blank, that a language's reference takes; and the share of all documents with a language
#: that it takes to serve documents without one (so at most 1 / share references do).
MIN_DOCUMENTS, MIN_SHARE = 20, 0.001
#: Copies of the serving references, so that the documents without a language never meet in one task.
SALTS = 64
#: Limits of the two distances: base + slack / sqrt(words), since short texts stray further from any reference; and of
#: the sum of both distances as shares of their limits.  Texts with fewer words than the minimum are not compared.
CLASS_BASE, CLASS_SLACK = 0.16, 0.7
WORD_BASE, WORD_SLACK = 0.15, 1.6
MAX_JOINT, MIN_WORDS = 1.7, 20
#: Words that two equal windows must have in common to count as repeated.
WINDOW = 8

_CLASS_OF = (
    ("a", "abcdefghijklmnopqrstuvwxyz"),
    ("A", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("0", "0123456789"),
    (" ", WORD_SPACE),
    (".", ".,;:'\"-()"),
    ("!", "!?"),
    ("+", "@^~=+_\\/[]{}`"),
    ("#", "#*$%&"),
    ("|", "|<>"),
)
N_CLASSES = len(_CLASS_OF) + 1
#: What stands between two runs of letters.
_NO_LETTERS = r"[^\p{L}]+"


def class_counts(text: Column) -> Column:
    """Characters of a text by class of ``_CLASS_OF`` and, last, all of them.

    Small letters, the bulk of most texts, go by whole runs first, since
    translating and taking out look at every character by itself.
    """
    others = _CLASS_OF[1:]

    def split(whole: Column) -> Column:
        return _let(F.regexp_replace(whole, "[a-z]+", ""), lambda rest: _let(mapped(whole, rest), counted))

    def mapped(whole: Column, rest: Column) -> Column:
        small = (F.length(whole) - F.length(rest)).cast("long")
        rest = F.translate(rest, "".join(m for _, m in others), "".join(c * len(m) for c, m in others))
        return F.struct(small.alias("small"), rest.alias("rest"))

    def counted(t: Column) -> Column:
        parts = F.array(*[F.lit(c) for c, _ in others])
        sizes = _taken_out(t["rest"], parts, F.octet_length, lambda rest, part: F.replace(rest, part, F.lit("")))
        return F.concat(F.array(t["small"]), sizes, F.array(t["small"] + F.length(t["rest"])))

    # broken bytes are made characters first, as the regular expression would, so that both lengths count them alike
    return _let(F.make_valid_utf8(text), split)


def _taken_out(whole: Column, parts: Column, size, without) -> Column:
    """By how much ``size`` falls as each of ``parts`` is taken out of ``whole``; later parts search what is left.

    No part may come about, or go, where another one is taken out.
    """
    start = F.struct(whole.alias("rest"), F.array().cast("array<long>").alias("sizes"))

    def step(acc: Column, part: Column) -> Column:
        sizes = F.concat(acc["sizes"], F.array(size(acc["rest"]).cast("long")))
        return F.struct(without(acc["rest"], part).alias("rest"), sizes.alias("sizes"))

    sizes = F.aggregate(parts, start, step, lambda acc: F.concat(acc["sizes"], F.array(size(acc["rest"]).cast("long"))))
    return _let(sizes, lambda s: F.transform(parts, lambda part, i: F.get(s, i) - F.get(s, i + 1)))


def _shares(counts: Column) -> Column:
    """Shares of the classes, and of all other characters, from ``class_counts``."""

    def run(c: Column) -> Column:
        total = F.greatest(F.element_at(c, -1), F.lit(1))
        known = F.slice(c, 1, N_CLASSES - 1)
        rest = F.element_at(c, -1) - F.aggregate(known, F.lit(0).cast("long"), lambda a, b: a + b)
        return F.transform(F.concat(known, F.array(rest)), lambda n: n / total)

    return _let(counts, run)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _letter_runs(text: Column) -> Column:
    """Lower-case letter runs of a text."""
    return F.array_remove(F.split(F.lower(text), _NO_LETTERS), "")


def _window_hashes(words: Column) -> Column:
    """Hash of every ``WINDOW``-word window: words are joined to hashes of pairs, these to fours, to eights."""

    def doubled(width: int):
        def run(h: Column) -> Column:
            n = F.size(h) - width
            return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(width + 1), n), lambda a, b: F.xxhash64(a, b))

        return run

    out = words
    for width in (1, 2, 4):
        out = _let(out, doubled(width))
    return out


def with_repeated_words(df: DataFrame, words: str) -> DataFrame:
    """Adds ``n_repeat_words``: words inside ``WINDOW``-word windows found twice or more in the text, the first included.

    Texts without an equal pair of windows are done after one distinct; in
    the others windows are sorted by hash and place, those with an equal
    neighbour are repeated, and the words from their places on are counted
    once each.
    """

    def covered(h: Column) -> Column:
        at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return _let(at, places)

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return _let(F.sort_array(F.transform(twice, lambda x: x["at"])), spans)

    def spans(p: Column) -> Column:
        steps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(WINDOW), b - a))
        return F.aggregate(steps, F.lit(WINDOW).cast("long"), lambda n, k: n + k)

    windows = F.when(F.size(words) > WINDOW, _window_hashes(F.col(words)))
    # the distinct stands outside of lambda functions, where it is compiled for numbers
    found = df.withColumn("_windows", windows).withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    n = F.when(F.col("_repeats"), covered(F.col("_windows"))).otherwise(F.lit(0).cast("long"))
    return found.withColumn("n_repeat_words", n).drop("_windows", "_repeats")


def base_measures(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` of the whole text.

    ``class_counts`` is added too.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    class_of = {c: k for k, (c, _) in enumerate(_CLASS_OF)}

    def of(c: str) -> Column:
        return F.get("class_counts", F.lit(class_of[c]))

    parsed = df.withColumns({"_words": word_array(whole), "_lines": lines, "class_counts": class_counts(whole)})
    return (
        with_repeated_words(parsed, "_words")
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.element_at("class_counts", -1) - of(" "),
                "n_symbols": of("#") + of("|"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            }
        )
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
        .drop("_words", "_lines")
    )


def references(docs: DataFrame, counts: Column | None = None) -> DataFrame:
    """One row per language, and one with null lang for all documents: ``lang, docs, classes, words, shares``.

    docs: documents that are not blank; classes: their mean class shares;
    words and shares: the ``COMMON_WORDS`` words with the greatest mean shares
    of the documents' words, so that no long document decides.  Counted over
    all documents, for every language with a document that is not blank.
    ``counts``: their ``class_counts``, where ``docs`` has them already.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    counts = class_counts(whole) if counts is None else counts
    src = docs.select(F.col("lang").cast("string").alias("lang"), whole.alias("text"), counts.alias("counts"))
    sums = (
        src.filter(F.btrim(F.col("text"), F.lit(WORD_SPACE)) != "")
        .select("lang", _shares(F.col("counts")).alias("s"))
        .groupBy("lang")
        .agg(F.array(*[F.sum(F.get("s", F.lit(k))) for k in range(N_CLASSES)]).alias("s"), F.count("*").alias("n"))
        .select("lang", "n", F.posexplode("s").alias("k", "share"))
    )
    # split once: a filter on the number of words, also one that Spark infers from an exploded column, would split again;
    # and weighed before words are exploded, since what stands beside an explode is computed for every word
    letters = F.array_remove("words", "")
    words = (
        src.select("lang", F.split(F.lower("text"), _NO_LETTERS).alias("words"))
        .withColumn("weight", F.floor(F.lit(DOCUMENT_WEIGHT) / F.greatest(F.size(letters), F.lit(1))))
        .select("lang", "weight", F.explode(letters).alias("word"))
        .groupBy("lang", "word")
        .agg(F.sum("weight").alias("n"))
    )
    sums, words = written(sums, "class-sums"), written(words, "word-counts")
    everyone = F.lit(None).cast("string")
    classes = sums.filter("lang is not null").unionByName(sums.withColumn("lang", everyone)).groupBy("lang", "k").agg(
        (F.sum("share") / F.sum("n")).alias("share"), F.sum("n").alias("n")
    )
    classes = classes.groupBy("lang").agg(
        F.max("n").alias("docs"), F.sort_array(F.collect_list(F.struct("k", "share"))).share.alias("classes")
    )
    counts = words.filter("lang is not null").unionByName(
        words.withColumn("lang", everyone).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = (
        counts.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= COMMON_WORDS)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("c"))
    )
    common = common.join(total, common.lang.eqNullSafe(total.lang)).select(
        common.lang, F.col("c.word").alias("words"), F.transform("c.n", lambda n: n / F.col("total")).alias("shares")
    )
    return classes.join(common, classes.lang.eqNullSafe(common.lang), "left").select(
        classes.lang,
        "docs",
        "classes",
        F.coalesce("words", F.array().cast("array<string>")).alias("words"),
        F.coalesce("shares", F.array().cast("array<double>")).alias("shares"),
    )


def _serving(refs: DataFrame) -> DataFrame:
    """One row with the references (array ``serving``) that documents without one of their own are compared with.

    Those of the languages that have ``MIN_DOCUMENTS`` documents and
    ``MIN_SHARE`` of all documents with a language; the one of all documents
    where there is no such language.
    """
    known = F.col("lang").isNotNull()
    wide = (F.col("docs") >= MIN_DOCUMENTS) & (F.col("docs") >= MIN_SHARE * F.col("in_languages"))
    all_known = refs.agg(F.sum(F.when(known, F.col("docs"))).alias("in_languages"))
    ref = F.struct("classes", "words", "shares")
    found = refs.join(all_known).agg(  # one row
        F.collect_list(F.when(known & wide, ref)).alias("wide"), F.collect_list(F.when(~known, ref)).alias("everyone")
    )
    return found.select(F.when(F.size("wide") > 0, F.col("wide")).otherwise(F.col("everyone")).alias("serving"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (0 to 1, six decimals) of two histograms given as arrays of shares."""

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.round(F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2)), 6)


def _word_shares(runs: Column, words: Column) -> Column:
    """Shares of the given words, and of all others, among the letter runs of a text.

    One pass leaves only the given words, and most runs go by their length
    alone, so that the passes for each word are short.
    """
    longest = F.array_max(F.transform(words, F.octet_length))
    known = _let(longest, lambda most: F.filter(runs, lambda run: (F.octet_length(run) <= most) & F.array_contains(words, run)))
    n = F.greatest(F.size(runs), F.lit(1))
    return _with_rest(_let(n, lambda n: F.transform(_taken_out(known, words, F.size, F.array_remove), lambda k: k / n)))


def _with_rest(shares: Column) -> Column:
    return _let(shares, lambda s: F.concat(s, F.array(F.greatest(F.lit(0.0), 1 - F.aggregate(s, F.lit(0.0), lambda a, b: a + b)))))


def _nearest(text: Column, classes: Column, n_words: Column, refs: Column) -> Column:
    """``by_class, by_word, class_distance, word_distance`` to the nearest reference of an array.

    ``by_class`` and ``by_word`` are the distances as shares of their limits;
    the nearest reference has the least sum of both.
    """
    spread = F.sqrt(F.greatest(n_words, F.lit(1)))

    def compare(runs: Column, shares: Column):
        def run(ref: Column) -> Column:
            by_class = js_distance(shares, ref["classes"])
            by_word = js_distance(_word_shares(runs, ref["words"]), _with_rest(ref["shares"]))
            return _let(F.struct(by_class.alias("c"), by_word.alias("w")), judged)

        return run

    def judged(d: Column) -> Column:
        by_class = d["c"] / (F.lit(CLASS_BASE) + F.lit(CLASS_SLACK) / spread)
        by_word = d["w"] / (F.lit(WORD_BASE) + F.lit(WORD_SLACK) / spread)
        return F.struct(
            (by_class + by_word).alias("joint"), d["c"].alias("class_distance"), d["w"].alias("word_distance"),
            by_class.alias("by_class"), by_word.alias("by_word"),
        )

    return _let(F.struct(_letter_runs(text).alias("runs"), classes.alias("s")), lambda t: F.array_min(F.transform(refs, compare(t["runs"], t["s"]))))


def judge(docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """Measures and verdict of every document (columns ``doc_id, text, lang``).

    Returns ``doc_id``, the base measures, ``class_distance``,
    ``word_distance`` and ``kept``: not base_failed, and, in texts of at least
    ``MIN_WORDS`` words, no distance nor their joint share above its limit.
    Documents without a language, or in one of fewer than ``MIN_DOCUMENTS``
    documents, are compared with the nearest reference of the languages that
    serve others (``_serving``), which has the least joint share.  Null texts
    are empty and fail; repeated rows each come out; an empty table gives no
    rows; other columns are ignored.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    src = base_measures(src, F.col("text"))
    if refs is None:
        # the references rest on the same counts; it holds every text, so the codec decides what disk the job takes
        src = written(src, "measures", codec="zstd")
        refs = written(references(src, F.col("class_counts")), "references")
    # joined by their size, since a table may have any number of languages
    named = refs.filter((F.col("lang").isNotNull()) & (F.col("docs") >= MIN_DOCUMENTS)).select(
        F.col("lang").alias("r_lang"), F.struct("classes", "words", "shares").alias("own")
    )
    serving = _serving(refs).select("serving", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s_salt"))
    src = src.join(named, F.col("lang") == F.col("r_lang"), "left")
    salt = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(SALTS)).cast("int")
    src = src.withColumn("salt", F.when(F.col("own").isNull(), salt).otherwise(-1 - salt))
    src = src.join(serving, F.col("salt") == F.col("s_salt"), "left")
    compared = F.when(F.col("own").isNotNull(), F.array("own")).otherwise(F.col("serving"))
    found = src.withColumn("refs", compared).withColumn("d", _nearest(F.col("text"), _shares(F.col("class_counts")), F.col("n_words"), F.col("refs")))
    far = (F.col("n_words") >= MIN_WORDS) & ((F.col("d.by_class") > 1) | (F.col("d.by_word") > 1) | (F.col("d.joint") > MAX_JOINT))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
        "d.class_distance",
        "d.word_distance",
    )
