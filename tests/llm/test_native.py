"""Line dedup, sharding, rules and mixing against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tillcast.llm import linedup, mixing, quality_rules, sharding
from tillcast.llm.common import word_count

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "alpha beta gamma delta epsilon zeta eta theta"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


# --------------------------------------------------------------------------- line dedup
@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("abé漢") for _ in range(rng.randint(edits + 1, 30)))
        b = list(a)
        for _ in range(rng.randint(0, edits + 1)):
            at = rng.randrange(len(b) + 1)
            kind = rng.random()
            if kind < 0.4 and at < len(b):
                b[at] = rng.choice("abc")
            elif kind < 0.7:
                b.insert(at, rng.choice("abc"))
            elif at < len(b) and len(b) > edits + 1:
                del b[at]
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").repartition(2)
    got = df.select("a", "b", linedup.edit_distance_within(F.col("a"), F.col("b"), edits).alias("near")).collect()
    assert all(r.near == (distance(r.a, r.b) <= edits) for r in got) and len(got) == 150


def classes_by_hand(rows, min_chars, edits):
    """{(doc_id, line_no): first occurrence} from all pairs of lines."""
    at = defaultdict(list)
    for doc_id, text in rows:
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            if len(line) >= min_chars:
                at[line].append((-math.inf if doc_id is None else doc_id, k))
    lines = sorted(at)
    parent = {x: x for x in lines}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                parent[root(a)] = root(b)
    first = {}
    for x in lines:
        first[root(x)] = min([first.get(root(x), (math.inf, 0)), *at[x]])
    return {place: first[root(x)] for x in lines for place in at[x]}


def lines_found(df):
    doc_id, line_no = linedup.occurrence(F.col("class_place"))
    got = df.select("doc_id", "line_no", doc_id.alias("c"), line_no.alias("l"), "kept").collect()
    low = lambda x: -math.inf if x is None else x
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.c, r.l)) for r in got)
    return {(low(r.doc_id), r.line_no): (low(r.c), r.l) for r in got}


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_line_classes(docs_of, edits):
    rng = random.Random(3)
    base = [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(6, 9))) for _ in range(12)]
    rows = [(i, "\n".join(rng.choice(base)[rng.randint(0, 1) :] + rng.choice(["", "", "x", "é"]) for _ in range(3))) for i in range(20)]
    rows += [(100, None), (101, ""), (None, base[0] + "\nshort"), (102, "short\nshort"), (-5, base[1]), (-5, base[1])]
    docs = docs_of([(i, t, "en", "s") for i, t in rows])
    assert lines_found(linedup.line_classes(docs, 14, edits)) == classes_by_hand(rows, 14, edits)


def test_line_classes_with_hot_segments(docs_of, monkeypatch):
    """More lines than HOT share a half: found through the lengthened keys."""
    monkeypatch.setattr(linedup, "HOT", 4)
    head, rng = "the same first half of many lines ", random.Random(5)
    tails = ["".join(rng.choice("abcd") for _ in range(34)) for _ in range(8)]
    rows = []
    for k, t in enumerate(tails * 3):
        at = rng.randrange(34)
        rows.append((k, head + rng.choice([t, t[:at] + "z" + t[at + 1 :], t[:at] + t[at + 1 :], t[:at] + "y" + t[at:]])))
    rows += [(50 + k, t + head[::-1] + x) for k, t in enumerate(tails[:6]) for x in ("", "!")]
    docs = docs_of([(i, t, "en", "s") for i, t in rows])
    assert lines_found(linedup.line_classes(docs)) == classes_by_hand(rows, 20, 1)


def test_line_dedupe_keeps_columns(docs_of, spark):
    rows = [(2, f"{LONG}\nshort\n{LONG}!", "en", "s"), (1, f"{LONG}\nown line of document one", None, None), (3, None, "en", "s"), (4, LONG, "en", "s")]
    docs = docs_of(rows)
    out = linedup.dedupe(docs)
    assert out.dtypes == docs.dtypes
    got = {r.doc_id: (r.text, r.n_chars, r.row, r["count"]) for r in out.collect()}
    assert got == {
        1: (f"{LONG}\nown line of document one", len(LONG) + 25, "x", 5), 2: ("short", 5, "x", 5), 3: (None, None, "x", 5), 4: ("", 0, "x", 5),
    }
    assert linedup.dedupe(docs.limit(0)).count() == 0


# --------------------------------------------------------------------------- sharding
def shards_by_hand(rows, limit):
    """{prefix: [(doc_id, bytes)]}, splitting bit by bit."""
    bits = {i: bin(int(hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()[:15], 16))[2:].zfill(60) for i, _ in rows}
    out, todo = {}, [""]
    while todo:
        p = todo.pop()
        mine = [(i, n) for i, n in rows if bits[i].startswith(p)]
        if not mine:
            continue
        if sum(n for _, n in mine) <= limit or len(p) == 60:
            out[p] = mine
        else:
            todo += [p + "0", p + "1"]
    return out


@pytest.mark.parametrize("limit", [50, 400, 10**6])
def test_shards(spark, limit):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 3, 10, 39])) for i in range(300)] + [(None, 7), (None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, bytes long")
    got = sharding.shards(df, F.col("bytes"), limit).collect()
    want = shards_by_hand(rows, limit)
    found = defaultdict(list)
    for r in got:
        found[r.shard].append((r.doc_id, r.bytes))
        assert r.part == 0 and r.shard_bytes == sum(n for _, n in want[r.shard]) and r.shard_rows == len(want[r.shard])
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert {p: sorted(x, key=key) for p, x in found.items()} == {p: sorted(x, key=key) for p, x in want.items()}


def test_shards_of_one_id_and_of_a_huge_document(spark):
    rows = [(7, 30)] * 25 + [(8, 1000), (9, None), (10, 5)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, bytes long"), F.col("bytes"), 100).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    fill = defaultdict(int)
    for r in got:
        fill[r.shard, r.part] += r.bytes
        assert r.shard_bytes <= 100 or r.doc_id == 8
    assert all(n <= 100 or n == 1000 for n in fill.values())
    assert {(r.shard, r.part): r.shard_bytes for r in got} == dict(fill)
    assert sharding.shards(spark.createDataFrame([], "doc_id long, bytes long"), F.col("bytes"), 100).count() == 0


def test_shards_are_written(docs_of):
    """Whole rows land in their shard's files, also rows of one id and size that differ in text."""
    rows = [(i, "x" * (i % 40) + "é", "en", "s") for i in range(200)] + [(None, f"text {k:02d}", "en", f"s{k % 3}") for k in range(50)]
    docs = docs_of(rows)
    out = sharding.write_shards(docs, F.octet_length("text"), 100).withColumn("file", F.input_file_name())
    got = out.collect()
    assert out.select("row.*").dtypes == docs.dtypes
    assert Counter(tuple(r.row) for r in got) == Counter(map(tuple, docs.collect()))
    fill, files = defaultdict(int), defaultdict(set)
    for r in got:
        assert r.bytes == len(r.row.text.encode()) and r.place == f"s{r.shard}-{r.part}" and f"place={r.place}/" in r.file
        fill[r.shard, r.part] += r.bytes
        files[r.file].add((r.shard, r.part))
    assert max(fill.values()) <= 100 and {(r.shard, r.part): r.shard_bytes for r in got} == dict(fill)
    assert len(files) == len(fill) and all(len(x) == 1 for x in files.values())
    whole = sharding.write_shards(docs, limit=400).collect()
    assert all(r.shard_bytes <= 400 and r.bytes > len(r.row.text.encode()) for r in whole) and len(whole) == len(rows)
    assert sharding.write_shards(docs.limit(0)).count() == 0


# --------------------------------------------------------------------------- rules
def measures_by_hand(text):
    words = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


def test_rule_measures(docs_of, read_rows):
    rng = random.Random(2)
    odd = [None, "", " \t\n\x0b ", "a", "a b c d e f g h", " ".join("abcdefgh") + "\n" + " ".join("abcdefgh"), "Und " * 60, "x\ny\nx\n\n \nx"]
    odd += [" ".join(rng.choice("ab") for _ in range(rng.randint(7, 60))) for _ in range(30)]
    odd += ["wörd x # y\x85z " * 3, "|".join("abc") + " <p> 100%"]
    texts = odd + [r["text"] for r in read_rows("documents")]
    docs = docs_of([(i, t, "en" if i % 3 else None, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == measures_by_hand(t), t
        assert not (r.kept and r.base_failed)


def test_rule_verdicts(spark, read_rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in read_rows("labels", "sf0.01")}
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    good = [kept[i] for i, q in labels.items() if q == 1]
    bad = [kept[i] for i, q in labels.items() if q == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_rule_verdicts_without_a_language(spark, read_rows):
    """Good documents whose language is not known are kept in every language, bad ones go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    quality = {r["doc_id"]: r["quality"] for r in read_rows("labels", "sf0.01")}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    half = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    kept = defaultdict(list)
    for r in quality_rules.judge(half).collect():
        if r.doc_id % 2 and r.doc_id in quality and (quality[r.doc_id] == 0 or not r.base_failed):
            kept[lang[r.doc_id] if quality[r.doc_id] else "bad"].append(r.kept)
    assert set(kept) == {"de", "en", "es", "fr", "bad"}
    assert sum(kept.pop("bad")) == 0 and all(sum(x) / len(x) >= 0.9 for x in kept.values())


def _of_letters(letters, k):
    """A text of 30 words over a few letters."""
    rng = random.Random(f"{letters}{k}")
    return " ".join("".join(rng.choice(letters) for _ in range(2)) for _ in range(30))


def test_few_documents_are_no_reference(docs_of):
    """Languages of few documents are compared with the nearest reference, not with their own few documents."""
    rows = [(k, _of_letters("abc", k), "x", "s") for k in range(30)] + [(100 + k, _of_letters("XYZ", k), "y", "s") for k in range(30)]
    rows += [(200, _of_letters("abc", 7), "rare", "s"), (201, _of_letters("XYZ", 7), None, "s"), (202, "1 " * 40, "rare", "s")]
    got = {r.doc_id: r for r in quality_rules.judge(docs_of(rows)).collect()}
    assert got[200].word_distance == got[7].word_distance and got[200].class_distance == got[7].class_distance
    assert got[201].word_distance == got[107].word_distance and got[201].kept == got[107].kept
    assert got[202].word_distance > 0.9 and not got[202].kept


def test_all_documents_serve_where_no_language_has_a_reference(docs_of):
    rows = [(k, " ".join(f"w{j}" for j in range(25)), None if k % 2 else f"l{k}", "s") for k in range(10)]
    got = quality_rules.judge(docs_of([*rows, (10, None, None, None), (10, None, None, None)])).collect()
    assert len(got) == 12 and all(r.kept and r.class_distance == 0 and r.word_distance == 0 for r in got if r.doc_id < 10)
    assert not any(r.kept for r in got if r.doc_id == 10)


def test_long_text_is_one_document(docs_of):
    """A very long document does not decide its language's common words, long words among them."""
    usual = [f"ungewöhnlich{chr(97 + j)} wörterbuch" for j in range(15)]
    rows = [(k, " ".join(usual[k % 15 :] + usual[: k % 15]), "de", "s") for k in range(40)] + [(99, "andere " * 50_000, "de", "s")]
    got = {r.doc_id: r for r in quality_rules.judge(docs_of(rows)).collect()}
    assert all(got[k].kept and got[k].word_distance < 0.3 for k in range(40)) and got[99].word_distance > 0.7


def test_jensen_shannon(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
    cols = [F.array(*map(F.lit, x)) for x in (p, q)]
    got = spark.range(1).select(quality_rules.js_distance(*cols).alias("d")).first().d
    assert abs(got - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-6


# --------------------------------------------------------------------------- mixing
def targets_by_hand(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, budget, out = set(names), 1.5 * sum(sizes.values()), {}
    while left:
        w = sum(weight[s] for s in left)
        over = {s for s in left if budget * weight[s] / w > 2 * sizes[s]}
        if not over:
            return out | {s: budget * weight[s] / w for s in left}
        for s in over:
            out[s] = 2.0 * sizes[s]
            budget -= out[s]
        left -= over
    return out


def mix_rows():
    rng = random.Random(4)
    rows = [(i, " ".join("w" * 1 for _ in range(rng.randint(0, 30))), "en", rng.choice(["a", "a", "a", "b", "ü", "c", None])) for i in range(600)]
    return rows + [(9000, "one two three", "en", "b")] * 40 + [(9001, None, None, "empty"), (None, "x y", "en", "z"), (None, "x y", "en", "z")]


def test_mix_queue(docs_of):
    rows = mix_rows()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(SPACE.findall(t or ""))
    want = targets_by_hand(dict(sizes))
    docs = docs_of(rows)
    got = mixing.queue(docs, word_count(F.col("text"))).collect()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((i, len(SPACE.findall(t or "")), s) for i, t, _, s in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.times <= 2
        taken[r.source] += r.size * r.times
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    total = sum(want.values())
    assert total - 60 <= sum(taken.values()) <= total + 1e-6
    again = mixing.queue(docs.repartition(7), word_count(F.col("text"))).collect()
    assert Counter(again) == Counter(got)


def test_mix_rows(docs_of):
    rows = mix_rows()
    docs = docs_of(rows)
    served = mixing.queue(docs, word_count(F.col("text"))).collect()
    want = Counter()
    for r in served:
        want[r.doc_id, r.source] += r.times
    out = mixing.mix(docs)
    assert out.dtypes == docs.dtypes
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +want
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_tells_texts_of_one_key_apart(docs_of):
    """Rows that share id, source and size: their order is that of the texts, whatever the partitions, and each is taken."""
    rows = [(None, f"word{k:03d} two", "en", "a") for k in range(60)] + [(7, "same text", "en", "b")] * 30
    docs = docs_of(rows)
    want = Counter(r.text for r in mixing.mix(docs).collect())
    assert sum(want.values()) == sum(r.times for r in mixing.queue(docs, word_count(F.col("text"))).collect())
    assert max(n for t, n in want.items() if t != "same text") <= 2
    for n in (3, 8):
        again = mixing.mix(docs.orderBy(F.rand(n)).repartition(n)).collect()
        assert Counter(r.text for r in again) == want


def test_words_are_weighed_once_a_document(docs_of, monkeypatch):
    """What stands beside an explode is computed for every word, so a document's weight has to come before it."""
    plans = {}
    written = quality_rules.written
    monkeypatch.setattr(quality_rules, "written", lambda df, name: plans.update({name: df}) or written(df, name))
    quality_rules.references(docs_of([(i, "one two two", "en", "a") for i in range(30)])).collect()
    above, _, below = plans["word-counts"]._jdf.queryExecution().optimizedPlan().toString().partition("Generate explode")
    assert "array_remove" not in above and "array_remove" in below
    weight = quality_rules.DOCUMENT_WEIGHT // 3
    assert {r.word: r.n for r in plans["word-counts"].collect()} == {"one": 30 * weight, "two": 60 * weight}


def test_measures_take_less_disk_than_the_texts(docs_of, monkeypatch, tmp_path):
    """The intermediate table holds every whole text, so it has to be packed tighter than Spark's default does."""
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    docs = docs_of([(i, " ".join(rng.choice(words[: rng.randint(1, 3000)]) for _ in range(400)), "en", "a") for i in range(600)])
    docs.write.parquet(str(tmp_path / "docs"), compression="snappy")
    tables = {}
    written = quality_rules.written
    monkeypatch.setattr(quality_rules, "written", lambda df, name, **how: tables.setdefault(name, written(df, name, **how)))
    found = quality_rules.judge(docs)

    def size(folder):
        return sum(f.stat().st_size for f in folder.glob("*.parquet"))

    measures = Path(urlparse(tables["measures"].inputFiles()[0]).path).parent
    assert size(measures) < 0.8 * size(tmp_path / "docs")
    assert tables["measures"].agg(F.sum(F.length("text"))).first()[0] == docs.agg(F.sum(F.length("text"))).first()[0]
    assert found.count() == 600


def test_rules_look_at_less_text(docs_of):
    """Classes are translated after small letters went by runs; words are counted among known runs, not by a search of the text."""
    texts = ["", "the", "The  the-the, then THE bathe the", "of\x01\x02of the\x02", "été the\u2028été é 😀 #|!", "aä zz" * 400, "1 2 3"]
    docs = docs_of([(i, t, "en", "a") for i, t in enumerate(texts)])
    words = ["the", "of", "été"]
    classes, ref = F.array(F.lit(1.0)), F.struct(F.array(F.lit(1.0)).alias("classes"), F.array(*map(F.lit, words)).alias("words"), F.array(*[F.lit(0.2)] * 3).alias("shares"))
    nearest = quality_rules._nearest(F.col("text"), classes, F.lit(20), F.array(ref))
    found = docs.select("doc_id", quality_rules.class_counts(F.col("text")).alias("counts"), nearest["word_distance"].alias("distance"))
    plan = docs.select("text", quality_rules.class_counts(F.col("text")), nearest)._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(text" not in plan and "regexp_replace(lower(" not in plan and "array_contains" in plan
    got = {r.doc_id: r for r in found.collect()}
    for i, t in enumerate(texts):
        assert got[i].counts == [sum(c in chars for c in t) for _, chars in quality_rules._CLASS_OF] + [len(t)]
        runs = [x for x in re.split(r"[\W\d_]+", t.lower()) if x]
        p = [runs.count(w) / max(len(runs), 1) for w in words]
        p, q = [*p, 1 - sum(p)], [0.2, 0.2, 0.2, 0.4]
        kl = [a * math.log2(2 * a / (a + b)) for x, y in zip(p, q) for a, b in ((x, y), (y, x)) if a > 0]
        assert abs(got[i].distance - math.sqrt(max(0, sum(kl)) / 2)) < 1e-5
