"""Operators with Python parts: quality, top-k, packing, language, near duplicates, HTML."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillcast.llm import html_text, langid, packing, quality_pu, simhash, topk
from tillcast.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


# --------------------------------------------------------------------------- quality
def test_quality_held_out(spark, read_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_pu.learn(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", quality_pu.score(model, F.col("text")).alias("s")).collect()}
    tested = [(got[r["doc_id"]] >= 0.7, r["quality"] == 1) for r in read_rows("labels", "sf0.01") if held(r["doc_id"])]
    assert sum(a == b for a, b in tested) / len(tested) > 0.95
    kept = quality_pu.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, s in got.items() if s >= 0.7}


def test_quality_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_pu.learn(docs, labels), quality_pu.learn(docs, flipped)
    assert a.prior == b.prior and np.array_equal(a.weights, b.weights)


def test_quality_edges(docs_of, spark):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "x" * 300_000, "en", "s"), (None, "a b", None, None), (3, "other text", "en", "s")]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (3, 1)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0)):
        model = quality_pu.learn(docs, marks)
        scores = [r.s for r in docs.select(quality_pu.score(model, F.col("text")).alias("s")).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert quality_pu.keep_good(docs.limit(0), labels).count() == 0


def test_nnpu_finds_the_negatives():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(1, 1, (3000, 4)), rng.normal(-1, 1, (1000, 4))
    model = quality_pu.fit_nnpu(pos[:1000], np.vstack([pos[1000:], neg[:666]]), 0.75)
    assert (model.score(pos) >= 0.5).mean() > 0.93 and (model.score(neg) >= 0.5).mean() < 0.2


# --------------------------------------------------------------------------- top-k
def top_by_hand(rows, k):
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, [int(np.floor(float(x) * 64)) for x in v]))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for at, (q, w) in enumerate(usable):
        if q % 20 == 0:
            best = sorted((-dot(w, v), i) for other, (i, v) in enumerate(usable) if other != at)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [32_768, 70])
def test_top_k(spark, read_rows, block, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7 if block < 100 else 1024)
    monkeypatch.setattr(topk, "SEEDS", 40 if block < 100 else 2048)
    rows = [(r["vec_id"], r["embedding"]) for r in read_rows("embeddings")]
    rows += [(1000, None), (1001, [1.0, None]), (1020, [float("nan")] * 4), (1040, [float("inf")]), (None, [1.0]), (1060, []), (1080, [0.5, 0.25])]
    rows += rows[:5] + [(2000 + i, rows[0][1]) for i in range(30)] + [(3, [9.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = df.select("vec_id", topk.integer_vector(F.col("embedding")).alias("v"))
    got = topk.top_k(vectors, F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted(map(tuple, got)) == top_by_hand([(i, None if v is None else list(v)) for i, v in rows], 20)


def test_top_k_repeated_ids(spark):
    """Rows that repeat an id are candidates each, and queries each."""
    df = spark.createDataFrame([(20, [1, 1]), (1, [2, 0]), (1, [0, 3]), (2, [1, 0])], "vec_id long, v array<long>")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0).collect())) == [(20, 1, 1, 3), (20, 2, 1, 2), (20, 3, 2, 1)]
    twice = spark.createDataFrame([(0, [1]), (0, [2]), (0, [2])], "vec_id long, v array<long>")
    got = topk.top_k(twice, F.col("vec_id") % 20 == 0, 1).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 0, 2), (0, 1, 0, 4), (0, 1, 0, 4)]


def test_top_k_few(spark):
    df = spark.createDataFrame([(0, [1]), (1, [2])], "vec_id long, v array<long>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 2)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# --------------------------------------------------------------------------- packing
ODD = ["", None, "It's we'll <|endoftext|>x <|startoftext|> don't İstanbul Σας é naïve_x ÀÉ1a 漢字 \x1c a\x85b\t\tq", " a ", "\n\n", "'s x's!", "É́ é"]


def test_pack_round_trip(docs_of, read_rows):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    texts = [r["text"] for r in read_rows("documents")] + ODD + ["long words " * 9000, "same", "same"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "no id", None, None)] + [(5000, "copy " * 40, "en", "s")] * 30
    got = packing.pack(docs_of(rows), path, 4096).collect()
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    check_layout(got, 4096)
    total = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= -(-total // 4096) + 1


def test_pack_yields_token_ids(docs_of):
    """Sequences are made of ids, from which texts come back; repeated rows stay apart."""
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    texts = [t for t in ODD if t] + ["long words " * 300, "same", "same"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(7000, "copy of one " * 50, "en", "s")] * 4
    got = packing.pack(docs_of(rows), path, 128).collect()
    tokenizer = Tokenizer.from_file(path)
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in sorted(got, key=lambda r: (r.copy, r.piece)):
        assert r.length == len(r.ids) and zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
        documents[r.doc_id, r.copy] += r.ids
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == len(sequences[r.sequence_id])
        sequences[r.sequence_id] += r.ids
    want = Counter((i, *tokenizer.encode(t, add_special_tokens=False).ids, 1) for i, t, *_ in rows)
    assert Counter((i, *ids) for (i, _), ids in documents.items()) == want
    assert max(map(len, sequences.values())) <= 128


def check_layout(got, capacity):
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_pack_merges_problems(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "PROBLEM_SIZE", 40)
    rng = random.Random(1)
    rows = [(i, "a " * rng.randint(1, 60), "en", "s") for i in range(700)]
    got = packing.pack(docs_of(rows), tokenizer_path("word_bpe_49k.json"), 64).collect()
    check_layout(got, 64)
    short = [r for r in got if r.length < 64]
    assert len(short) == 700
    by_hand = packing._refit([], sorted(range(700), key=lambda i: -short[i].length), [r.length for r in short], 64)
    assert len({r.sequence_id for r in short}) <= 1.05 * len(by_hand)  # problems of 40 pieces
    assert packing.pack(docs_of(rows).limit(0), tokenizer_path("word_bpe_49k.json"), 64).count() == 0


def test_evolution_improves_and_keeps_items():
    rng = random.Random(0)
    sizes = [rng.randint(20, 70) for _ in range(120)]
    first = packing._refit([], sorted(range(120), key=lambda i: -sizes[i]), sizes, 100)
    best = packing.evolve(sizes, 100, 3, generations=40)
    assert sorted(i for b in best for i in b) == list(range(120)) and max(sum(sizes[i] for i in b) for b in best) <= 100
    assert packing._fitness(best, sizes, 100) <= packing._fitness(first, sizes, 100)
    a, b = first, packing._refit([], list(range(120)), sizes, 100)
    child = packing._crossover(a, b, sizes, 100, random.Random(1))
    assert sorted(i for x in child for i in x) == list(range(120)) and {tuple(sorted(x)) for x in child} & {tuple(sorted(x)) for x in b}


# --------------------------------------------------------------------------- language
def test_forward_sums_all_segmentations():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    pieces = langid.Pieces.read(path)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(0)
    p = rng.random((pieces.size, 2)) + 0.01
    model = langid.LanguageModel(pieces, ["a", "b"], p / p.sum(axis=0), np.zeros(2))
    known = sorted({t for t in map(sp.id_to_piece, range(sp.get_piece_size())) if (c := t.removeprefix("▁")) == "" and t or langid.LETTERS.fullmatch(c) and c == c.lower()})
    number = {t: i for i, t in enumerate(known)}
    assert len(number) == pieces.n_pieces

    def by_hand(word):
        text = "▁" + word
        sums = [np.ones(2)]
        for end in range(1, len(text) + 1):
            total = np.zeros(2)
            for at in range(end):
                if text[at:end] in number:
                    total += sums[at] * model.probability[number[text[at:end]]]
            if text[end - 1] not in number:
                total += sums[end - 1] * model.probability[[pieces.n_pieces + b for b in text[end - 1].encode()]].prod(axis=0)
            sums.append(total)
        return np.log(sums[-1])

    words = ["the", "nation", "ça", "été", "ꙮ", "漢字", "straße", "a", "xqzzt", "w" * 40]
    assert np.allclose(model.word_scores(words), [by_hand(w) for w in words])
    # expected counts under equal probabilities: bytes and pieces of a word spell it in every segmentation
    counts = langid.expected_counts(pieces, {"x": Counter({"nation": 3, "漢": 2})})["x"]
    length = {number[t]: len(t) for t in number}
    spelled = sum(counts[i] * n for i, n in length.items())
    assert abs(spelled - (3 * 7 + 2 * (2 if "漢" in number else 1))) < 1e-6


def test_language_held_out(spark, read_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs, tokenizer_path("piece_bpe_32k.model"))
    got = {r.doc_id: r.p for r in docs.select("doc_id", langid.predict(model, F.col("text")).alias("p")).collect()}
    tested = [got[r["doc_id"]].lang_pred == r["lang"] for r in read_rows("documents", "sf0.01") if held(r["doc_id"])]
    assert sum(tested) / len(tested) > 0.95 and all(0 <= p.score <= 1 for p in got.values())


def test_language_edges(docs_of):
    rows = [(i, "the of and to in", "en", "s") for i in range(8)] + [(20 + i, "und der die das ist", "de", "s") for i in range(8)]
    odd = [(100, None, "en", None), (101, "", None, None), (102, "123 %%% --", "en", "s"), (None, "der", None, None), (103, "der " + "w" * 200_000, "de", "s")]
    docs = docs_of(rows + odd)
    model = langid.learn(docs, tokenizer_path("piece_bpe_32k.model"))
    got = [(r.doc_id, r.p.lang_pred) for r in docs.select("doc_id", langid.predict(model, F.col("text")).alias("p")).collect()]
    assert [x for _, x in got[:16]] == ["en"] * 8 + ["de"] * 8 and dict(got[16:])[100] == dict(got[16:])[101] == dict(got[16:])[102] == "und"
    nothing = langid.learn(docs.limit(0), tokenizer_path("piece_bpe_32k.model"))
    assert {r.p.lang_pred for r in docs.select(langid.predict(nothing, F.col("text")).alias("p")).collect()} == {"und"}


# --------------------------------------------------------------------------- near duplicates
def print_by_hand(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))


def components_by_hand(prints, distance):
    """{row number: smallest doc_id}, from all pairs."""
    group = list(range(len(prints)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= distance:
                group[root(i)] = root(j)
    low = defaultdict(list)
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            low[root(i)].append(doc_id)
    return [min(low[root(i)], default=None) for i in range(len(prints))]


def near_rows(read_rows):
    rows = [(r["doc_id"], r["text"], "en", "s") for r in read_rows("documents")]
    odd = [(900, None, None, None), (901, "", "en", "s"), (902, " \n", "en", "s"), (903, "One", "en", "s"), (904, "one", "en", "s"), (905, "É é", "en", "s")]
    return rows + odd + [(None, "one", None, None), (None, "only null ids here", None, None), (7, rows[7][1], "en", "s"), (906, rows[7][1] + " tail", "en", "s")]


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_near_duplicates(docs_of, read_rows, distance):
    rows = near_rows(read_rows)
    got = simhash.components(docs_of(rows), 3, distance).collect()
    prints = [(i, print_by_hand(t)) for i, t, *_ in rows]
    want = components_by_hand(prints, distance)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    assert Counter((r.doc_id, r.fp, r.component_id) for r in got) == Counter((i, signed(f), c) for (i, f), c in zip(prints, want))


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_links_of_crowded_fingerprints(spark, distance):
    """Fingerprints around a few centres, in the same and in both segments."""
    rng = random.Random(distance)
    values = set()
    for centre in (0, (1 << 64) - 1, rng.getrandbits(64)):
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in values], "fp long")
    for hot in (simhash.HOT_PAIRS, 30) if distance == 2 else (300,):  # with and without splitting of crowded values
        got = [(r.u, r.v) for r in simhash.links(df, distance, hot).collect()]
        want = {(signed(x), signed(y)) for x in values for y in values if signed(x) < signed(y) and (x ^ y).bit_count() <= distance}
        assert len(got) == len(set(got)) and set(got) == want
    from tillcast.llm.graph import connected_components

    found = {r.node: r.root for r in connected_components(simhash.links(df, distance)).collect()}
    got = defaultdict(set)
    for x in values:
        got[found.get(signed(x), signed(x))].add(x)
    want = defaultdict(set)
    for x, c in zip(values, components_by_hand([(i, x) for i, x in enumerate(values)], distance)):
        want[c].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_segments_and_radii():
    """Segments cut the 64 bits; whatever bits differ, one segment is within its radius."""
    for number in (1, 10**5, 10**7, 10**10):
        for distance in range(7):
            parts = simhash.segments(number, distance)
            assert sorted(b for p in parts for b in p) == list(range(64))
            radii = simhash._radii(len(parts), distance)
            assert min(radii) >= -1 and sum(r + 1 for r in radii) == distance + 1


def test_dedupe_keeps_one_of_each(docs_of, read_rows):
    rows = near_rows(read_rows)
    docs = docs_of(rows)
    out = simhash.dedupe(docs)
    assert out.dtypes == docs.dtypes
    prints = [(i, print_by_hand(t)) for i, t, *_ in rows]
    kept = Counter(r.doc_id for r in out.collect())
    groups = Counter(components_by_hand(prints, 2))
    assert kept == Counter({c: 1 for c in groups})
    assert simhash.dedupe(docs.limit(0)).count() == 0


# --------------------------------------------------------------------------- HTML
def test_html_blocks():
    tree = html_text.train()
    x, y = html_text.labelled_blocks()
    assert all((html_text.decide(tree, r) >= 0.5) == bool(v) for r, v in zip(x, y))
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body class="home">
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B &amp; C</a></li></ul></nav><!-- <p>gone</p> -->
    <div class="cookie-notice">We use cookies on this long and winding page of ours</div>
    <article><h2>Head&shy;line &lt;one&gt;</h2><p>First   <b>bold</b>
      <i>words</i> go here&nbsp;now<br>and here, in a paragraph that is long.</p><p>Short.<p>Un<em>closed</em> paragraph with <a href=x>one link</a> in it.
      <div class='ad'>Buy the thing that you do not need</div><table><tr><td>cell one</td><td>cell two</td></tr></table></article>
    <section id="comments"><p>I am a reader and I say a lot of things about this article here</p></section>
    <form><p>Name</p><button>Go</button></form><aside><p>Other news of the day that nobody reads at all</p></aside>
    <footer>&copy; 2020 by us</footer></body></html>"""
    assert html_text.main_text(page, tree) == (
        "Head­line <one>\nFirst bold words go here now and here, in a paragraph that is long.\nShort.\n"
        "Unclosed paragraph with one link in it.\ncell one\ncell two"
    )


def test_html_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", "<!-- open"), (5, "u", "<script>x"), (6, "u", "plain text only, no tags at all"), (7, "u", "<article>" + "<p>w w w</p>" * 5000), (8, "u", "<" * 2000), (9, "u", "<a <b <c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.t for r in df.select("page_id", html_text.extract(F.col("html")).alias("t")).collect()}
    assert got[1] == got[2] == got[4] == got[5] == "" and got[6] == "plain text only, no tags at all" and got[7].count("\n") == 4999


def test_html_names_that_only_mention_other_parts():
    """A word inside a compound class or id does not take the article away; unclosed elements swallow nothing."""
    tree = html_text.train()
    body = "<p>" + "word " * 40 + "</p><p>short one</p><p>" + "more " * 35 + "</p>"
    want = "\n".join([" ".join(["word"] * 40), "short one", " ".join(["more"] * 35)])
    for page in (
        f'<div class="content has-sidebar">{body}</div>',
        f'<div class="page no-sidebar"><article>{body}</article></div>',
        f'<div class="layout-sidebar-right"><main>{body}</main></div>',
        f'<div class="site withMenu">{body}</div>',
        f"<article><button>{body}</article>",
        f"<article><button><button>x</button>{body}</article>",
        f"<article><iframe src=x>{body}</article><footer>the end</footer>",
        f"<article><svg><svg></svg><text>no</text></svg>{body}</article>",
    ):
        assert html_text.main_text(page, tree) == want, page
    share = html_text.main_text(f'<div id="share-story">{body}</div>', tree).split("\n")
    assert share[0] == want.split("\n")[0] and share[-1] == want.split("\n")[-1]
    for name in ("comments", "post-comments", "commentList", "cookie-notice", "site-footer", "ad", "sidebar", "nav menu"):
        page = f'<article>{body}</article><div class="{name}"><p>{"spam " * 50}</p><article>{"reply " * 40}</article></div>'
        assert html_text.main_text(page, tree) == want, name
    assert html_text.main_text(f'<article>{body}</article><article class="comment">{"spam " * 40}</article>', tree) == want
    assert html_text.main_text(f"<article>{body}</article><script>{body}", tree) == want


def test_html_tables(spark):
    """Repeated rows, an empty table, clashing names and a very long page."""
    long = "<article>" + "<p>" + "w " * 300_000 + "</p></article>"
    rows = [(1, "<p>a b c d e f g h i j</p>"), (1, "<p>a b c d e f g h i j</p>"), (2, long)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("mine")).withColumn("n_chars", F.lit(1))
    got = [(r.page_id, r.text, len(r.t)) for r in df.select("*", html_text.extract(F.col("html")).alias("t")).orderBy("page_id").collect()]
    assert got[0] == got[1] and got[2] == (2, "mine", 599_999)
    assert df.where("false").select(html_text.extract(F.col("html")).alias("t")).count() == 0


def test_html_pages(spark):
    import re
    from html import unescape

    for r in spark.read.parquet(f"{SF}/pages.parquet").withColumn("t", html_text.extract(F.col("html"))).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.t == "\n".join(p for p in parts if p)


def test_crossover_and_migration_beat_best_fit():
    """Where best fit decreasing misses the bound, islands that evolve and take in each other's elite need fewer bins."""
    rng = random.Random(8)
    sizes = [rng.randint(1024, 2048) for _ in range(400)]
    fit = packing._refit([], sorted(range(400), key=lambda i: -sizes[i]), sizes, 4096)
    assert len(fit) > -(-sum(sizes) // 4096)
    elites = [packing.evolve(sizes, 4096, seed, generations=25) for seed in (1, 2)]
    best = packing.evolve(sizes, 4096, 3, start=elites, generations=25)
    assert sorted(i for b in best for i in b) == list(range(400)) and all(sum(sizes[i] for i in b) <= 4096 for b in best)
    assert len(best) <= min(map(len, elites)) <= max(map(len, elites)) < len(fit)


def test_cutting_words_takes_few_bytes_a_byte():
    """Words are counted and placed without running sums over all bytes of a group, which held 8 bytes for each."""
    import tracemalloc

    import pyarrow as pa

    from tillcast.llm import bytewords

    texts = pa.array(["some words of a long text\n" * 40_000])
    size = texts.nbytes
    tracemalloc.start()
    words = bytewords.cut(texts, packing._BLANKS, parts=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words.code) == 240_000 and peak < 25 * size


def test_packing_encodes_small_groups(docs_of, monkeypatch):
    """What a worker encodes at once is bounded by packing's own limit, below that of other word cutters."""
    from tillcast.llm import bytewords

    import pyarrow as pa

    assert packing._GROUP_BYTES <= bytewords.GROUP_BYTES // 2
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 1000] * 100)], ["text"])
    assert [b.num_rows for b in bytewords.grouped(iter([batch]), 50_000)] != [100]
    assert sum(b.num_rows for b in bytewords.grouped(iter([batch]), 50_000)) == 100
