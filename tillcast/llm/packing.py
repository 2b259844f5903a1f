"""Packing documents into token sequences with a grouping genetic algorithm on islands.

Documents are tokenised and cut into pieces; pieces shorter than a sequence
are dealt to problems of bounded size.  Several islands evolve each problem
apart, hand their elites to the next island, and evolve again.  Bins that stay
underfilled are merged into fewer problems and evolved further.
"""

from __future__ import annotations

import ctypes
import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import bytewords
from tillcast.llm.common import written

END_ID = 1
#: Pieces of one packing problem; the group that one task holds never grows with the corpus.
PROBLEM_SIZE = 4096
ISLANDS = 2
POPULATION, GENERATIONS = 4, 6
#: Bins filled below this share go to a merged problem.
OPEN_BELOW = 0.995
NO_BIN = -1
#: Words that a task remembers.
_CACHE_WORDS = 700_000
#: Bytes of text that are encoded together; the arrays of one group hold some 25 times as much.
_GROUP_BYTES = 4 << 20
#: What the look-up of whole words cuts at; the tokenizer itself drops all other white space.
_BLANKS = bytewords.byte_classes(b" \n")
#: Pieces in one Arrow batch out; with their ids, each holds up to four bytes a token.
_BATCH_PIECES = 512
#: What the query and the checks compare; the ids themselves are the operator's output.
DIGEST = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# ---------------------------------------------------------------------------
# tokens
# ---------------------------------------------------------------------------
class WordEncoder:
    """Token ids of whole texts through a word-wise tokenizer file, one look-up per word.

    The tokenizer never joins text across white space, so a text's ids are
    its blank-separated parts' ids in a row.  Parts are remembered (a bounded
    number); unseen ones go through the ``tokenizers`` library.  Latin words
    are encoded once for all their capitalisations and trailing punctuation.
    """

    _LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)\Z")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts: dict[str, bytes] = {"": b""}
        self.old_parts: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {"": b""}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn_cores(self, words: list[str]) -> None:
        for at in range(0, len(words), 1024):
            some = words[at : at + 1024]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) == len(some):
                raw = ids.tobytes()
                self.cores.update(zip(some, map(raw.__getitem__, map(slice, [0, *cuts], cuts))))
            else:
                self.cores.update(zip(some, self._encode(some)))

    def _learn(self, unseen: set[str]) -> dict[str, bytes]:
        """Ids of parts that are not remembered; they are remembered from now on."""
        if len(self.parts) + len(unseen) > _CACHE_WORDS:
            self.old_parts, self.parts = self.parts, {"": b""}
        if len(self.cores) > _CACHE_WORDS:
            self.cores = {"": b""}
        again = self.old_parts.keys() & unseen
        fresh = {p: self.old_parts[p] for p in again}
        lone = [p for p in unseen - again if p.isascii() and p.isalpha() and p.islower()]
        self._learn_cores([p for p in lone if p not in self.cores])
        fresh.update(zip(lone, map(self.cores.__getitem__, lone)))
        latin, other = [], []
        for part in unseen - fresh.keys():
            m = self._LATIN.match(part)
            if m:
                latin.append((part, m[1].lower(), m[2]))
            else:
                other.append(part)
        self._learn_cores([c for c in dict.fromkeys(c for _, c, _ in latin) if c not in self.cores])
        tails = [t for t in dict.fromkeys(t for _, _, t in latin) if t not in self.cores]
        self.cores.update(zip(tails, self._encode(tails) if tails else []))
        fresh.update((p, self.cores[c] + self.cores[t]) for p, c, t in latin)
        if other:
            fresh.update(zip(other, self._encode(other)))
        self.parts.update(fresh)
        return fresh

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column in a row, ``END_ID`` after each text, and where each text begins (and the end).

        Words are cut and numbered on the column's bytes; each different one is
        looked up once, and its ids are taken by its number.  The tokenizer
        takes letters in lower case and apart from what follows them, so words
        are cut there too, unless the column spells out a special token.
        """
        octets = texts.buffers()[2].to_pybytes() if texts.buffers()[2] is not None else b""
        plain = not any(x in octets for x in self.special)
        del octets
        words = bytewords.cut(texts, _BLANKS, lower=plain, parts=plain)
        spelled = words.spelling.to_pylist()
        found = list(map(self.parts.get, spelled))
        if None in found:
            fresh = self._learn({w for w, x in zip(spelled, found) if x is None})
            found = [fresh[w] if x is None else x for w, x in zip(spelled, found)]
        known = np.frombuffer(b"".join(found), dtype="<u4")
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        del spelled, found
        begin = np.cumsum(size) - size
        n = size[words.code]
        before = np.cumsum(n) - n
        of_text = np.bincount(words.row, weights=n, minlength=len(texts)).astype(np.int64) + 1
        starts = np.r_[0, np.cumsum(of_text)]
        out = np.full(starts[-1], END_ID, dtype="<u4")
        token = np.arange(n.sum())
        out[token + np.repeat(words.row, n)] = known[token + np.repeat(begin[words.code] - before, n)]
        return out, starts


_encoders: dict[str, WordEncoder] = {}


def _return_freed_memory() -> None:
    """Let this worker give freed arrays of 1 MiB and more back at once, Arrow's too (elsewhere than on glibc: only Arrow's).

    By default glibc raises that limit to the largest array freed, and the
    remembered words among the arrays keep the heap from shrinking.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt") and hasattr(libc, "malloc_trim"):
        m_mmap_threshold, m_trim_threshold = -3, -1
        libc.mallopt(m_mmap_threshold, 1 << 20)
        libc.mallopt(m_trim_threshold, 1 << 20)
        libc.malloc_trim(0)  # what earlier stages left in a worker that is used again


def _encoder(path: str) -> WordEncoder:
    """The worker's encoder; it is kept from task to task."""
    if path not in _encoders:
        _return_freed_memory()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """One row per piece: ``uid, copy, doc_id, piece, start, length, ids_crc32, ids``.

    A document is its token ids and then ``END_ID``; only documents longer
    than ``capacity`` are cut, into full pieces and a last shorter one.  Null
    texts count as empty (one piece of length 1).  ``ids`` are the piece's
    token ids.  ``uid`` tells pieces apart, and ``copy`` (the uid of a row's
    first piece) rows, repeated ones too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        uid = TaskContext.get().partitionId() << 40
        for batch in bytewords.grouped(batches, _GROUP_BYTES):
            ids, starts = encoder.ids_of(batch.column("text"))
            whole = np.diff(starts)
            n = -(-whole // capacity)
            row = np.repeat(np.arange(len(n)), n)
            first = np.repeat(np.cumsum(n) - n, n)
            place = np.arange(len(row)) - first
            length = np.minimum(capacity, whole[row] - place * capacity)
            cuts = np.r_[0, np.cumsum(length)]
            octets = memoryview(ids).cast("B")
            checks = [crc32(octets[a:b]) for a, b in zip((4 * cuts[:-1]).tolist(), (4 * cuts[1:]).tolist())]
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.view("<i4")))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(uid + np.arange(len(row))),
                    pa.array(uid + first),
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(place.astype(np.int32)),
                    pa.array(place * capacity),
                    pa.array(length),
                    pa.array(checks, pa.int64()),
                    lists,
                ],
                names=["uid", "copy", "doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )
            uid += len(row)
            for at in range(0, len(row), _BATCH_PIECES):
                yield out.slice(at, _BATCH_PIECES)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(
        run, "uid long, copy long, doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"
    )


# ---------------------------------------------------------------------------
# one problem
# ---------------------------------------------------------------------------
class _Bins:
    """Bins under construction; the fullest bin with room is found by a bit mask of the free sizes."""

    def __init__(self, capacity: int, bins: list[list[int]], sizes: list[int]):
        self.capacity, self.sizes, self.bins = capacity, sizes, bins
        self.free = [capacity - sum(sizes[i] for i in b) for b in bins]
        self.by_free: dict[int, list[int]] = {}
        self.mask = 0
        for k, f in enumerate(self.free):
            self._open(k, f)

    def _open(self, k: int, f: int) -> None:
        if f:
            self.by_free.setdefault(f, []).append(k)
            self.mask |= 1 << f

    def best_fit(self, items: list[int]) -> None:
        for i in items:
            size = self.sizes[i]
            room = self.mask >> size
            if room:
                f = size + (room & -room).bit_length() - 1
                k = self.by_free[f].pop()
                if not self.by_free[f]:
                    self.mask ^= 1 << f
                self.bins[k].append(i)
            else:
                k, f = len(self.bins), self.capacity
                self.bins.append([i])
                self.free.append(f)
            self.free[k] = f - size
            self._open(k, f - size)


def _fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Smaller is better: the number of bins, then how unevenly they are filled."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def _crossover(a, b, sizes, capacity, rng) -> list[list[int]]:
    """Inject well-filled bins of ``b`` into ``a``, drop a's bins that share items, best-fit what that displaces."""
    ranked = sorted(b, key=lambda x: -sum(sizes[i] for i in x))
    best = ranked[: max(1, len(ranked) // 2)]
    injected = [x for x in best if rng.random() < 0.5] or best[:1]
    taken = {i for x in injected for i in x}
    kept, displaced = [list(x) for x in injected], []
    for x in a:
        rest = [i for i in x if i not in taken]
        if len(rest) == len(x):
            kept.append(list(x))
        else:
            displaced += rest
    return _refit(kept, displaced, sizes, capacity)


def _refit(kept, displaced, sizes, capacity) -> list[list[int]]:
    out = _Bins(capacity, kept, sizes)
    out.best_fit(sorted(displaced, key=lambda i: -sizes[i]))
    return out.bins


def _mutate(a, sizes, capacity, rng) -> list[list[int]]:
    """Break the emptiest bins and a few others, and best-fit their items again."""
    ranked = sorted(a, key=lambda x: sum(sizes[i] for i in x))
    worst = max(1, len(ranked) // 20)
    broken = {id(x) for x in ranked[:worst]} | {id(x) for x in rng.sample(ranked, min(len(ranked), worst + 1))}
    return _refit([list(x) for x in a if id(x) not in broken], [i for x in a if id(x) in broken for i in x], sizes, capacity)


def evolve(sizes: list[int], capacity: int, seed: int, start: list[list[list[int]]] = (), generations: int = GENERATIONS):
    """Best packing of ``sizes`` that an island finds, as lists of item numbers; ``start``: packings to begin from.

    Ends early once no packing can have fewer bins.
    """
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    people = [[list(b) for b in p] for p in start]
    people.append(_refit([], order, sizes, capacity))
    key = lambda p: _fitness(p, sizes, capacity)
    people.sort(key=key)
    if len(people[0]) <= least:
        return people[0]
    while len(people) < POPULATION:
        noisy = sorted(order, key=lambda i: -sizes[i] * rng.uniform(0.7, 1.3))
        filled = _Bins(capacity, [], sizes)
        filled.best_fit(noisy)
        people.append(filled.bins)
    for _ in range(generations):
        people.sort(key=key)
        if len(people[0]) <= least:
            break
        mother, father = people[0], people[rng.randrange(1, len(people))]
        children = [
            _crossover(mother, father, sizes, capacity, rng),
            _crossover(father, mother, sizes, capacity, rng),
            _mutate(mother, sizes, capacity, rng),
        ]
        people = sorted(people + children, key=key)[:POPULATION]
    return people[0]


# ---------------------------------------------------------------------------
# islands
# ---------------------------------------------------------------------------
_ISLAND = "problem long, island int, uids array<long>, sizes array<long>, bins array<int>, n_bins int, unfit double"


def _numbered(packing: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(packing):
        for i in b:
            out[i] = k
    return out


def _lists(numbers) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(numbers):
        out.setdefault(int(k), []).append(i)
    return list(out.values())


def _epoch(capacity: int, epoch: int):
    """Each row an island with its starting packings; out: the same with its best one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                sizes = [int(s) for s in r.sizes]
                start = [_lists(p) for p in r.starts if len(p)]
                seed = hash((int(r.problem), int(r.island), epoch))
                best = evolve(sizes, capacity, seed, start)
                n, unfit = _fitness(best, sizes, capacity)
                out.append((r.problem, r.island, list(r.uids), sizes, _numbered(best, len(sizes)), n, unfit))
            yield pd.DataFrame(out, columns=["problem", "island", "uids", "sizes", "bins", "n_bins", "unfit"])

    return run


def _solve(items: DataFrame, capacity: int) -> DataFrame:
    """``uid, length, problem, bin`` for items ``uid, length, problem, prior`` (prior: bin so far, or ``NO_BIN``)."""
    gathered = items.groupBy("problem").agg(F.sort_array(F.collect_list(F.struct("uid", "length", "prior"))).alias("x"))
    islands = gathered.select(
        "problem",
        F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        F.col("x.uid").alias("uids"),
        F.col("x.length").alias("sizes"),
        F.filter(F.array("x.prior"), lambda p: ~F.array_contains(p, NO_BIN)).alias("starts"),
    )
    first = written(islands.mapInPandas(_epoch(capacity, 0), _ISLAND), "islands")
    # elites stay and also go to the next island
    moved = first.select(
        "problem",
        F.explode(F.array(F.col("island"), (F.col("island") + 1) % ISLANDS)).alias("island"),
        "uids",
        "sizes",
        "bins",
    )
    second = (
        moved.groupBy("problem", "island")
        .agg(F.first("uids").alias("uids"), F.first("sizes").alias("sizes"), F.collect_list("bins").alias("starts"))
        .mapInPandas(_epoch(capacity, 1), _ISLAND)
    )
    best = second.groupBy("problem").agg(
        F.min_by(F.struct("uids", "sizes", "bins"), F.struct("n_bins", "unfit", "island")).alias("b")
    )
    return best.select("problem", F.explode(F.arrays_zip("b.uids", "b.sizes", "b.bins")).alias("i")).select(
        F.col("i.uids").alias("uid"), F.col("i.sizes").alias("length"), "problem", F.col("i.bins").alias("bin")
    )


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """``copy, doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids`` per piece of every document.

    The ``ids`` of a sequence's pieces, by ``offset``, are the training
    sequence; ``copy`` tells repeated rows apart, which share their doc_id.
    Pieces of ``capacity`` tokens are sequences by themselves.  The others are
    dealt to problems of about ``PROBLEM_SIZE`` pieces each (by row, so equal
    documents spread), solved on ``ISLANDS`` islands; bins under
    ``OPEN_BELOW`` are merged into fewer problems, solved again from their
    present packing, as long as that halves the number of problems.  Repeated
    rows are packed each; null texts are empty documents; an empty table
    gives no rows; other columns are ignored.
    """
    cut = written(pieces(docs, tokenizer_path, capacity), "pieces")
    short = cut.filter(F.col("length") < capacity).select("uid", "length")
    problems = max(1, -(-short.count() // PROBLEM_SIZE))
    items = short.select(
        "uid", "length", F.pmod(F.xxhash64("uid"), F.lit(problems)).alias("problem"), F.lit(NO_BIN).cast("long").alias("prior")
    )
    done, level = None, 0
    while True:
        placed = written(_solve(items, capacity), "placed").withColumn(
            "sequence_id", (F.col("problem") * (1 << 20) + F.col("bin")) * 64 + level
        )
        fills = placed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
        below = fills.filter(F.col("fill") < F.lit(OPEN_BELOW * capacity)).select("sequence_id")
        last = problems == 1
        if not last:
            left = written(placed.join(below, "sequence_id", "left_semi").select("uid", "length", "sequence_id"), "open")
            merged = max(1, -(-left.count() // PROBLEM_SIZE))
            last = merged > problems // 2
        kept = placed if last else placed.join(below, "sequence_id", "left_anti")
        kept = kept.select("uid", "length", "sequence_id")
        done = kept if done is None else done.union(kept)
        if last:
            break
        items = left.select(
            "uid",
            "length",
            F.pmod(F.xxhash64("sequence_id"), F.lit(merged)).alias("problem"),
            F.col("sequence_id").alias("prior"),
        )
        problems, level = merged, level + 1
    offsets = done.selectExpr(
        "uid",
        "sequence_id",
        "sum(length) over (partition by sequence_id order by uid rows unbounded preceding) - length as offset",
    )
    full = cut.filter(F.col("length") == capacity).select(
        "*", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = cut.filter(F.col("length") < capacity).join(offsets, "uid")
    names = ["copy", *DIGEST, "ids"]
    return full.select(*names).unionByName(rest.select(*names))
