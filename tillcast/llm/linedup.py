"""Line deduplication by a segment-partition edit join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import packed, written
from tillcast.llm.graph import connected_components

#: Lines shorter than this are left alone; lines within this edit distance are one.
MIN_CHARS, MAX_EDITS = 20, 1
#: A segment that more distinct lines share is looked up with a longer key.
HOT = 32


# ---------------------------------------------------------------------------
# edit distance
# ---------------------------------------------------------------------------
def edit_distance_within(a: Column, b: Column, edits: int) -> Column:
    """True if the Levenshtein distance of ``a`` and ``b`` is at most ``edits``.

    Bit-parallel over the band of 2 * edits + 1 diagonals: a whole column of
    the band is two bit vectors (vertical steps up and down) that a few word
    operations advance by one character.  The score is followed down the
    band's lowest diagonal and then along the last row.  Both strings must
    be longer than ``edits``.
    """
    top = 2 * edits
    full = (1 << (top + 1)) - 1
    lanes = range(top + 1)

    def long(x: int) -> Column:
        return F.lit(x).cast("long")

    def run(s: Column) -> Column:
        rows, columns = s["a"], s["b"]
        m, n = F.size(rows), F.size(columns)

        def match(ch: Column, i: Column) -> Column:
            bits = [F.when(F.get(rows, i + (k - edits)) == ch, long(1 << k)).otherwise(long(0)) for k in lanes]
            out = bits[0]
            for x in bits[1:]:
                out = out + x
            return out

        matches = F.transform(columns, match)

        def step(state: Column, i: Column) -> Column:
            up, down = state["up"], state["down"]
            x = F.get(s["match"], i)
            zero = ((x.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(x).bitwiseOR(down).bitwiseAND(long(full))

            def advance(d0: Column) -> Column:
                right = down.bitwiseOR(F.bitwise_not(d0.bitwiseOR(up)).bitwiseAND(long(full)))
                left = d0.bitwiseAND(up)
                moved = F.shiftright(d0, 1)
                row = long(1) * F.pow(F.lit(2.0), F.lit(top - 1) - (i - (m - edits))).cast("long")
                diagonal = F.when(d0.bitwiseAND(long(1 << top)) == 0, 1).otherwise(0)
                along = F.when(right.bitwiseAND(row) != 0, 1).otherwise(0) - F.when(left.bitwiseAND(row) != 0, 1).otherwise(0)
                return F.struct(
                    left.bitwiseOR(F.bitwise_not(moved.bitwiseOR(right)).bitwiseAND(long(full))).alias("up"),
                    moved.bitwiseAND(right).alias("down"),
                    (state["score"] + F.when(i < m - edits, diagonal).otherwise(along)).alias("score"),
                )

            return F.get(F.transform(F.array(zero), advance), F.lit(0))

        start = F.struct(long(full & ~((1 << edits) - 1)).alias("up"), long(0).alias("down"), F.lit(edits).alias("score"))

        def fold(t: Column) -> Column:
            nonlocal s
            s = t
            return F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda z: z["score"])

        return F.get(F.transform(F.array(F.struct(matches.alias("match"))), fold), F.lit(0))

    pair = F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b"))
    score = F.get(F.transform(F.array(pair), run), F.lit(0))
    return (F.abs(F.length(a) - F.length(b)) <= edits) & (score <= edits)


# ---------------------------------------------------------------------------
# segments
# ---------------------------------------------------------------------------
def _segment(length: Column, i: int, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment i (from 0) of a line of the given length; the later segments are the longer."""
    parts = edits + 1
    short = F.floor(length / parts).cast("int")
    extra = length - short * parts
    longer_before = F.greatest(F.lit(0), F.lit(i) - (F.lit(parts) - extra))
    return short * i + longer_before + 1, short + F.when(F.lit(i) >= F.lit(parts) - extra, 1).otherwise(0)


def _keys(line: Column, edits: int) -> list[Column]:
    """Structs ``key, segment, shorter, index``: the line's own segments, and the substrings with which it probes the
    segments of lines of its length and of up to ``edits`` characters less."""
    length = F.length(line)
    out = []

    def entry(target: Column, i: int, start: Column, width: Column, shorter: int, index: bool) -> Column:
        key = F.xxhash64(target, F.lit(i), F.substring(line, start, width))
        return F.struct(key.alias("key"), F.lit(i).alias("segment"), F.lit(shorter).alias("shorter"), F.lit(index).alias("index"))

    for i in range(edits + 1):
        start, width = _segment(length, i, edits)
        out.append(entry(length, i, start, width, 0, True))
        for shorter in range(edits + 1):
            start, width = _segment(length - shorter, i, edits)
            low = max(-i, shorter - (edits - i))
            high = min(i, shorter + (edits - i))
            out += [entry(length - shorter, i, start + shift, width, shorter, False) for shift in range(low, high + 1)]
    return out


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, line_no, line`` of every line; null texts have none."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    return src.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _place() -> Column:
    """Order of line occurrences: doc_id (null first), then line number, as one number."""
    return F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("decimal(38,0)") * F.lit(1 << 31).cast("decimal(12,0)") + F.col("line_no")


def _identity(df: DataFrame) -> DataFrame:
    """Adds the 96-bit identity ``h1, h2`` of a line's text."""
    return df.withColumns({"h1": F.xxhash64("line"), "h2": F.hash("line")})


def _texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``h1, h2, line`` for the distinct lines ``needed`` (h1, h2, doc_id, line_no).

    What is needed grows with the corpus, so here and in ``similar`` it is
    merged, not broadcast: the plan is the same at every size.
    """
    by_doc = needed.groupBy("doc_id").agg(F.collect_set("line_no").alias("wanted")).withColumnRenamed("doc_id", "w_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(by_doc.hint("merge"), F.col("doc_id").eqNullSafe(F.col("w_id")))
    wanted = F.transform(F.col("wanted"), lambda k: F.get(F.col("lines"), k))
    lines = found.withColumn("lines", F.split("text", "\n")).select(F.explode(wanted).alias("line")).filter("line is not null")
    return _identity(lines.select("line")).join(needed.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_semi").distinct()


def similar(docs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """Edges ``u, v`` (structs h1, h2) that connect all eligible distinct lines within ``edits``.

    ``lines``: ``h1, h2, doc_id, line_no, keys``.  A line is cut into edits +
    1 segments; of two lines within ``edits``, one segment of the shorter
    stands unchanged in the longer, near its place.  So every line enters its
    segments under (length, segment number, content), and probes with its
    substrings at the possible places.  Pairs that meet are verified by
    banded bit-parallel edit distance.

    A segment that more than ``HOT`` distinct lines share would make pairs by
    the square.  There (for one edit) the key is lengthened by the rest of
    the line with one character left out: lines of one length that meet then
    differ in that character alone, and a longer line meets exactly the
    shorter one that it extends.  No link is lost, and what meets is linked.
    """
    entries = lines.select("h1", "h2", F.explode("keys").alias("k")).select("h1", "h2", "k.*")
    index, probes = entries.filter("index"), entries.filter("not index")
    hot = index.groupBy("key").count().filter(F.col("count") > HOT).select("key")
    hot = written(hot if edits == 1 else hot.limit(0), "hot-segments")
    has_hot = not hot.isEmpty()

    def cold(df: DataFrame) -> DataFrame:
        return df.join(hot, "key", "left_anti") if has_hot else df

    left = cold(probes).select("key", "shorter", F.struct("h1", "h2").alias("v"))
    right = cold(index).select("key", F.struct("h1", "h2").alias("u"))
    pairs = left.join(right, "key").filter("(shorter > 0 and u <> v) or u < v").select("u", "v").distinct()
    pairs = written(pairs, "line-pairs")
    needed = pairs.select("u.*").union(pairs.select("v.*"))
    if has_hot:
        warm = written(entries.join(hot, "key", "left_semi"), "hot-lines")
        needed = needed.union(warm.select("h1", "h2"))
    places = lines.select("h1", "h2", "doc_id", "line_no").join(needed.distinct().hint("merge"), ["h1", "h2"], "left_semi")
    texts = written(_texts_of(docs, written(places, "needed-lines")), "line-texts")
    if has_hot:
        pairs = pairs.union(_hot_pairs(warm, texts))
    a = texts.select(F.struct("h1", "h2").alias("u"), F.col("line").alias("a"))
    b = texts.select(F.struct("h1", "h2").alias("v"), F.col("line").alias("b"))
    return pairs.distinct().join(a, "u").join(b, "v").filter(edit_distance_within(F.col("a"), F.col("b"), edits)).select("u", "v")


def _hot_pairs(warm: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``u, v`` among lines that share a hot segment, for one edit."""
    lined = warm.join(texts, ["h1", "h2"]).withColumn("len", F.length("line"))
    first_width = _segment(F.col("len") - F.col("shorter"), 0, 1)[1]
    last_width = _segment(F.col("len") - F.col("shorter"), 1, 1)[1]
    # what stands beside the shared segment
    rest = F.when(F.col("segment") == 0, F.substring("line", first_width + 1, F.col("len"))).otherwise(
        F.substring("line", F.lit(1), F.col("len") - last_width)
    )
    lined = lined.select("key", F.struct("h1", "h2").alias("id"), "shorter", "index", rest.alias("rest"))
    holes = F.expr(
        "transform(sequence(1, length(rest)), p -> struct(p, xxhash64(substring(rest, 1, p - 1), p, substring(rest, p + 1)) as sub, "
        "xxhash64(concat(substring(rest, 1, p - 1), substring(rest, p + 1))) as del))"
    )
    same = lined.filter("index").filter("rest <> ''").select("key", "id", F.explode(holes).alias("o"))
    lowest = Window.partitionBy("key", "o.p", "o.sub")
    same = same.select(F.min("id").over(lowest).alias("u"), F.col("id").alias("v")).filter("u <> v")
    longer = lined.filter("not index and shorter = 1 and rest <> ''").select("key", F.col("id").alias("v"), F.explode(holes).alias("o"))
    shorter = lined.filter("index").select(F.col("key").alias("k"), F.col("id").alias("u"), F.xxhash64("rest").alias("whole"))
    grown = longer.join(shorter, (F.col("key") == F.col("k")) & (F.col("o.del") == F.col("whole"))).select("u", "v")
    return same.union(grown).filter("u <> v").distinct()


# ---------------------------------------------------------------------------
# classes
# ---------------------------------------------------------------------------
def line_classes(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = MAX_EDITS) -> DataFrame:
    """``doc_id, text_hash, line_no, class_place, place, kept`` for every line of at least ``min_chars`` characters.

    Lines are one class if chains of lines within ``edits`` edits (equal
    ones included) join them.  ``class_place`` is the class's first
    occurrence by (doc_id, line number); only that one is kept.  Rows equal
    in doc_id count as one document: their lines at equal places are the
    same occurrence.  Null ids sort first; null texts have no lines; an
    empty table gives no rows.
    """
    if min_chars <= edits:
        raise ValueError("min_chars must exceed the edits")
    occurrences = _identity(_lines(docs).filter(F.length("line") >= min_chars))
    if edits:
        keys = F.array(*_keys(F.col("line"), edits)).alias("keys")
    else:
        keys = F.array().alias("keys")
    n_keys = len(_keys(F.lit(""), edits)) if edits else 0
    flat = occurrences.select("h1", "h2", _place().alias("place"), keys)
    # all lines of a group are equal, so any one's keys do; numbers only, so the sums stay in hash tables
    firsts = flat.groupBy("h1", "h2").agg(
        F.min("place").alias("place"), *[F.min(F.col("keys")[k]["key"]).alias(f"key{k}") for k in range(n_keys)]
    )
    shape = [(e["segment"], e["shorter"], e["index"]) for e in _shape(edits)]
    rebuilt = F.array(
        *[
            F.struct(
                F.col(f"key{k}").alias("key"), F.lit(s).alias("segment"), F.lit(d).alias("shorter"), F.lit(x).alias("index")
            )
            for k, (s, d, x) in enumerate(shape)
        ]
    )
    firsts = written(firsts, "distinct-lines")
    doc_id, line_no = occurrence(F.col("place"))
    distinct = firsts.select(
        "h1",
        "h2",
        "place",
        doc_id.alias("doc_id"),
        line_no.alias("line_no"),
        (rebuilt if edits else F.array()).alias("keys"),
    )
    if edits:
        roots = connected_components(similar(docs, distinct, edits)).select("node.h1", "node.h2", "root")
        linked = roots.join(firsts.select("h1", "h2", "place"), ["h1", "h2"])
        lowest = linked.groupBy("root").agg(F.min("place").alias("low"))
        low = written(linked.join(lowest, "root").select("h1", "h2", "low"), "linked-lines")
        classes = firsts.join(low, ["h1", "h2"], "left").select("h1", "h2", F.coalesce("low", "place").alias("class_place"))
    else:
        classes = firsts.select("h1", "h2", F.col("place").alias("class_place"))
    named = occurrences.select("h1", "h2", "doc_id", "text_hash", "line_no", _place().alias("place")).join(classes, ["h1", "h2"])
    return named.select(
        "doc_id", "text_hash", "line_no", "class_place", "place", (F.col("place") == F.col("class_place")).alias("kept")
    )


def _shape(edits: int) -> list[dict]:
    """Segment, shorter and index of each entry of ``_keys``, in its order."""
    out = []
    for i in range(edits + 1 if edits else 0):
        out.append({"segment": i, "shorter": 0, "index": True})
        for shorter in range(edits + 1):
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            out += [{"segment": i, "shorter": shorter, "index": False} for _ in range(low, high + 1)]
    return out


def occurrence(place: Column) -> tuple[Column, Column]:
    """doc_id and line number of a place or ``class_place``."""
    unit = F.lit(1 << 31).cast("decimal(12,0)")
    line_no = F.pmod(place, unit)
    doc_id = ((place - line_no) / unit).cast("decimal(20,0)")
    return F.when(doc_id != F.lit(-(1 << 63)), doc_id).cast("long"), line_no.cast("int")


def dedupe(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = MAX_EDITS) -> DataFrame:
    """``docs`` with every line but its class's first occurrence taken out of ``text``, other columns as they are.

    Shorter lines stay.  A column ``n_chars`` is brought up to date.  A text
    may become empty; null texts stay null.
    """
    gone = (
        line_classes(docs, min_chars, edits)
        .filter("not kept")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("line_no").alias("gone"))
        .select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), "gone")
    )
    rows = packed(docs).select(
        "row", F.col("row.doc_id").cast("long").alias("k_id"), F.xxhash64(F.col("row.text").cast("string")).alias("k_hash")
    )
    joined = rows.join(written(gone, "gone-lines").hint("merge"), F.col("k_id").eqNullSafe(F.col("g_id")) & (F.col("k_hash") == F.col("g_hash")), "left")
    lines = F.split(F.col("row.text").cast("string"), "\n")
    kept = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains(F.col("gone"), s["i"]))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))
    fresh = joined.select("row", text.alias("text"))
    out = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text"), F.lit(0)).cast("long")}
    columns = [
        (F.when(F.col("text").isNull(), F.col(f"row.`{c}`")).otherwise(out[c]) if c == "n_chars" else out[c]).cast(t).alias(c)
        if c in out
        else F.col(f"row.`{c}`")
        for c, t in docs.dtypes
    ]
    return fresh.select(*columns)
