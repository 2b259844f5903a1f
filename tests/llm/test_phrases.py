"""Collocations, source divergence and BPE against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import bpe, collocations, divergence
from tillcast.llm.queries import tokenizer_path

ODD_ROWS = [
    (1, "The old man, the old MAN! the old man\nthe old", "en", "a"),
    (1, "The old man, the old MAN! the old man\nthe old", "en", "a"),
    (2, None, "en", "b"),
    (3, "", None, None),
    (4, "the\told  man the old man x\x0ey the old x\x0e the old man", "en", "b"),
    (None, "über straße über straße. über\x0bstraße über", None, None),
    (5, "...,;\n\n", "fr", "c"),
    (6, "un deux un deux un deux trois", "fr", None),
    (7, "un deux trois un deux trois", "fr", "c"),
    (8, "la " * 40, "fr", "d"),
]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def phrases_by_hand(rows, least, longest, top):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        some = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inner = lambda p: {p[i:j] for i in range(len(p)) for j in range(i + 1, len(p) + 1)} - {p}
        covered = {q for p, a in some.items() for q in inner(p) if q in some and 100 * a >= 100 * some[q]}
        rows = []
        for p in some.keys() - covered:
            cuts = [(1000 * c[p] * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((-score, -c[p], " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(docs, least, longest=5, top=2000, part_rows=collocations.PART_ROWS):
    found = collocations.best(collocations.collocations(docs, least, longest, part_rows), top)
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("part_rows", [collocations.PART_ROWS, 7])
def test_collocations_by_hand(docs_of, part_rows):
    assert mined(docs_of(ODD_ROWS), 2, part_rows=part_rows) == phrases_by_hand(ODD_ROWS, 2, 5, 2000)


def test_collocations_of_documents(docs_of, read_rows):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in read_rows("documents")]
    got = mined(docs_of(rows), 4, top=300, part_rows=900)
    assert len(got) > 300 and got == phrases_by_hand(rows, 4, 5, 300)


def test_collocations_filter_loses_nothing(docs_of, monkeypatch):
    """A filter table far too small lets phrases through, which changes no count."""
    monkeypatch.setattr(collocations, "LEAST_BITS", 6)
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    assert mined(docs_of(ODD_ROWS), 2) == phrases_by_hand(ODD_ROWS, 2, 5, 2000)


def test_collocations_of_nothing(docs_of):
    assert mined(docs_of([]), 2) == []
    assert mined(docs_of([(1, "a b", "en", "s")]), 2) == []


def test_lockstep_meets_parts(spark):
    """Prefix counts and equal longer counts hold across the edges of parts."""
    words = [("a",), ("a", "b"), ("a", "b", "c"), ("a", "b", "d"), ("b",), ("b", "c"), ("c",), ("d",), ()]
    counts = {w: 9 - 2 * len(w) + (w == ("a", "b", "d")) * 2 for w in words}
    stream = spark.createDataFrame([("x", list(w), f) for w, f in counts.items()], "lang string, words array<string>, f long")
    for rows in (100, 1):
        found = collocations.lockstep(stream, len(words), rows)
        merged = found.groupBy("words").agg(F.max("f"), F.max("heads"), F.bool_or("covered"))
        for w, f, heads, covered in merged.collect():
            w = tuple(w)
            assert f == counts[w] and (heads or []) == [counts[w[:k]] for k in range(1, len(w))]
            longer = [x for x in words if len(x) == len(w) + 1 and x[: len(w)] == w]
            assert covered == any(counts[x] == f for x in longer)


def audit_by_hand(rows, least=3, top=200):
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = [lowered(w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(words)
        docs[lang].update(set(words))
        sources[lang].add(source)
    out = []
    for lang, some in sources.items():
        kept = [w for w, d in docs[lang].items() if d >= least]
        total = {w: sum(counts[lang, s][w] for s in some) for w in kept}
        whole = sum(total.values()) + len(kept)
        q = {w: 1 + 10**9 * (total[w] + 1) // whole for w in kept}
        p = {}
        for s in some:
            size = sum(counts[lang, s][w] for w in kept) + len(kept)
            p[s] = {w: 1 + 10**9 * (counts[lang, s][w] + 1) // size for w in kept}
        for s in some:
            pairs = [(-sum((p[s][w] - p[h][w]) ** 2 // p[h][w] for w in kept), h.encode()) for h in some - {s}]
            terms = [(-((p[s][w] - q[w]) ** 2 // q[w]), w.encode()) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


def audited(docs, **options):
    found = divergence.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in found.collect())


def test_audit_by_hand(docs_of):
    assert audited(docs_of(ODD_ROWS), min_docs=2) == audit_by_hand(ODD_ROWS, 2)
    assert audited(docs_of(ODD_ROWS), min_docs=50) == audit_by_hand(ODD_ROWS, 50)  # no kept terms: values 0
    assert audited(docs_of([])) == []


@pytest.mark.parametrize("options", [{}, {"group_block": 3, "block_rows": (60, 20), "pools": 3}])
def test_audit_of_documents(docs_of, read_rows, options):
    rows = [(r["doc_id"], r["text"], r["lang"] if r["doc_id"] % 7 else None, r["source"]) for r in read_rows("documents")]
    got = audited(docs_of(rows), top_terms=20, **options)
    assert {x[2] for x in got} == {"pair", "term"} and got == audit_by_hand(rows, top=20)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def hostile_texts(n, seed=5):
    rng = random.Random(seed)
    some = "aeiounrtsl'’ \n\t  0123.,;é漢🙂<|>\x00\x1c\x85\xa0　Ᲊ\U00013460"
    for _ in range(n):
        yield "".join(rng.choice(some) for _ in range(rng.randint(0, 60)))
        yield "".join(rng.choice("abehinot") for _ in range(rng.randint(30, 900)))
        yield rng.choice("a=-_ \n9é漢") * rng.randint(1, 400) + rng.choice(["", "<|endoftext|>", " <|endoftext|> y"])


def test_bpe_equals_the_library(library):
    coder = bpe.ByteBpe(tokenizer_path("byte_bpe_50k.json"))
    for text in hostile_texts(700):
        want = library.encode(text, add_special_tokens=False).ids
        got = coder.encode(text)
        assert np.frombuffer(got, dtype="<u4").tolist() == want
        assert coder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_join_needs_wide_windows():
    """Halves of a run of one letter agree only far from the join; the result is that of merging the whole."""
    coder = bpe.ByteBpe(tokenizer_path("byte_bpe_50k.json"))
    for letter in (b"a", b"=", b" ", b"\xc3\xa9"):
        for size in (63, 200, 517):
            data = letter * size
            for cut in (1, 31, size // 2):
                assert coder.join(coder.merge(data[:cut]), coder.merge(data[cut:])) == coder.merge(data)


def by_library(library, rows):
    out = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), decoded))
    return sorted(out, key=str)


def encoded(docs, **options):
    path = tokenizer_path("byte_bpe_50k.json")
    found = bpe.encode(docs, path, **options)
    got = found.select("doc_id", "n_tokens", F.sha2("ids", 256), bpe.decode(F.col("ids"), path)).collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.mark.parametrize("run_bytes", [bpe.RUN_BYTES, 64])
def test_encode_documents(docs_of, library, run_bytes):
    """With runs of 64 bytes on dealt to tasks of their own, and without."""
    rng = random.Random(3)
    long = ["".join(rng.choice("abehinot") for _ in range(n)) for n in (64, 65, 700, 3000)]
    rows = [(k, t, "en", "s") for k, t in enumerate([*hostile_texts(15), *long, f"x {long[2]}. 9{long[1]}<|endoftext|>{long[3]} "])]
    rows += [(None, None, None, None), (1, "", "en", None), (1, "", "en", None), (7, " " * 500 + "a" * 300, "en", "s")]
    assert encoded(docs_of(rows), run_bytes=run_bytes) == by_library(library, rows)
    assert encoded(docs_of([]), run_bytes=run_bytes) == []
