"""Byte-level BPE by tree concatenation: halves are encoded apart and joined where both sides agree."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from tillcast.llm.common import written

#: Fixed value: how byte-level BPE cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes that are merged at once; longer ones are halved.
LEAF_BYTES = 32

#: Unsplit text from this length on is dealt to several tasks, in leaves of so many bytes.
RUN_BYTES = 1 << 16

#: Cached words of a worker.
_CACHED = 500_000

_BLANK_BEFORE_SPACE = re.compile(r"\s ")
_SPACE_AFTER_WORD = re.compile(r"(?<!\s) ")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _pattern() -> regex.Pattern:
    """``PATTERN`` by the library's Unicode version: characters that it does not know yet are no letters or numbers."""
    recent = regex.findall(r"[\p{L}\p{N}]", "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn"))
    cut = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    begun = {at for _, (at, _) in cut("".join(f"a{c}\n1{c}\n" for c in recent))}
    late = [c for k, c in enumerate(recent) if 6 * k + 1 in begun and 6 * k + 4 in begun]
    if not late:
        return regex.compile(PATTERN)
    ranges = "".join(f"{regex.escape(x[0])}-{regex.escape(x[-1])}" for x in _ranges(sorted(late)))
    here = PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{ranges}]]")
    here = here.replace(r" ?\p{L}+", rf" ?[\p{{L}}--[{ranges}]]+").replace(r" ?\p{N}+", rf" ?[\p{{N}}--[{ranges}]]+")
    return regex.compile(here, regex.V1)


def _ranges(letters: list[str]) -> Iterator[list[str]]:
    """Runs of neighbouring characters."""
    run: list[str] = []
    for x in letters:
        if run and ord(x) != ord(run[-1]) + 1:
            yield run
            run = []
        run.append(x)
    if run:
        yield run


class ByteBpe:
    """Encoder and decoder of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocab, merges = stored["model"]["vocab"], stored["model"]["merges"]
        letters = _byte_letters()
        octet = {c: b for b, c in letters.items()}
        self.single = [vocab[letters[b]] for b in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.never = len(pairs)
        self.special = {x["content"]: x["id"] for x in stored["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.octets = [b""] * size
        for token, k in vocab.items():
            self.octets[k] = bytes(octet[c] for c in token)
        for token, k in self.special.items():
            self.octets[k] = token.encode()
        self.table = pa.array(self.octets, pa.large_binary())
        self._split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._pattern = _pattern()
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, list[int]] = {}

    # -- one unsplit stretch of bytes -------------------------------------------------
    def merge(self, data: bytes) -> list[int]:
        """Merge neighbours, the lowest rank and then the leftmost first, until none is left."""
        ids = [self.single[b] for b in data]
        if len(ids) <= LEAF_BYTES:
            rank, never, made = self.rank.get, self.never, self.made
            ranks = [rank(p, never) for p in zip(ids, ids[1:])]
            while ranks:
                best = min(ranks)
                if best == never:
                    break
                i = ranks.index(best)
                ids[i : i + 2] = [made[best]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank((ids[i - 1], ids[i]), never)
                if i < len(ranks):
                    ranks[i] = rank((ids[i], ids[i + 1]), never)
            return ids
        ranked = self.rank
        after, before = list(range(1, len(ids))) + [-1], list(range(-1, len(ids) - 1))
        heap = [(ranked[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranked]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[best], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (ids[x], ids[y]) in ranked:
                    heapq.heappush(heap, (ranked[ids[x], ids[y]], x, ids[x], ids[y]))
        return [k for k in ids if k >= 0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of two stretches side by side from the encoding of each.

        A growing window around the join is merged afresh until its first token
        is the left side's own and its last the right side's.  Then every two
        neighbouring tokens are ones that BPE would not merge or cut otherwise,
        and such a sequence is the encoding of the whole.
        """
        if not left or not right:
            return left + right
        size = 1
        while True:
            a, b = left[-size:], right[:size]
            again = self.merge(b"".join(map(self.octets.__getitem__, a + b)))
            if (len(a) == len(left) or again[0] == a[0]) and (len(b) == len(right) or again[-1] == b[-1]):
                return left[: len(left) - len(a)] + again + right[len(b) :]
            size *= 2

    def tree(self, data: bytes) -> list[int]:
        """Encoding of one unsplit stretch: halves encoded apart, then joined."""
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    # -- texts ------------------------------------------------------------------------
    def stretches(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Unsplit stretches of a text in order; special tokens come with their id."""
        at = 0
        for found in self._split.finditer(text) if self._split else ():
            for x in self._pattern.findall(text[at : found.start()]):
                yield x, None
            yield found.group(), self.special[found.group()]
            at = found.end()
        for x in self._pattern.findall(text[at:] if at else text):
            yield x, None

    def _stretch(self, piece: str) -> list[int]:
        found = self._pieces.get(piece)
        if found is None:
            found = self.tree(piece.encode("utf-8", "surrogatepass"))
            if len(piece) <= LEAF_BYTES:
                if len(self._pieces) > _CACHED:
                    self._pieces.clear()
                self._pieces[piece] = found
        return found

    def _whole(self, text: str) -> bytes:
        out: list[int] = []
        for piece, special in self.stretches(text):
            out += [special] if special is not None else self._stretch(piece)
        return np.array(out, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit numbers.

        Text is always cut before a space that follows no white space, so such
        words with their space are looked up in a cache.
        """
        words = _SPACE_AFTER_WORD.split(text) if _BLANK_BEFORE_SPACE.search(text) else text.split(" ")
        known = self._words
        found = list(map(known.get, words))
        found[0] = self._whole(words[0])
        if None in found:
            if len(known) > _CACHED:
                known.clear()
            for i, x in enumerate(found):
                if x is None:
                    found[i] = known.get(words[i])
                    if found[i] is None:
                        found[i] = known[words[i]] = self._whole(" " + words[i])
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        """Text of little-endian unsigned 32-bit ids, special tokens included; broken characters become U+FFFD."""
        numbers = pa.array(np.frombuffer(ids, dtype="<u4").astype(np.int64))
        octets = self.table.take(numbers)
        ends = np.frombuffer(octets.buffers()[1], dtype=np.int64)[octets.offset : octets.offset + len(octets) + 1]
        whole = octets.buffers()[2]
        return (whole.to_pybytes()[ends[0] : ends[-1]] if whole else b"").decode("utf-8", "replace")


_coders: dict[str, ByteBpe] = {}


def coder(path: str) -> ByteBpe:
    return _coders.get(path) or _coders.setdefault(path, ByteBpe(path))


def _rows(run: Callable, names: list[str], kinds: list[pa.DataType]) -> Callable:
    """A function over Arrow batches from a generator of rows."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for row in run(parts):
            out.append(row)
            size += len(row[-1])
            if size > 4 << 20 or len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return batches


def has_long_run(text: Column, run_bytes: int) -> Column:
    """Whether a text may hold an unsplit stretch of ``run_bytes`` or more: that long, with words or blanks that long."""
    least = run_bytes // 4  # characters of that many bytes
    long = lambda parts: F.exists(parts, lambda x: F.length(x) >= least)
    return F.when(F.octet_length(text) < run_bytes, False).otherwise(long(F.split(text, r"\s+")) | long(F.split(text, r"\S+")))


def encode(docs: DataFrame, path: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every whole text of ``docs`` (doc_id, text); ids are little-endian unsigned 32-bit numbers.

    Texts are cut as the vocabulary's pattern does.  Texts with an unsplit
    stretch of ``run_bytes`` or more go through tasks of their own: its leaves
    are encoded in parallel and joined in pairs, level by level.

    Null texts count as empty (no token).  Repeated rows and ids come out as
    often as they went in; an empty table gives an empty result; other columns
    are ignored.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def whole(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = coder(path)
        for batch in parts:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                yield doc_id, bpe.encode(text)

    long = has_long_run(F.col("text"), run_bytes)
    plain = src.filter(~long).mapInArrow(
        _rows(whole, ["doc_id", "ids"], [pa.int64(), pa.binary()]), "doc_id long, ids binary"
    )
    both = plain.unionByName(_encode_long(src.filter(long), path, run_bytes))
    return both.select("doc_id", F.expr("cast(octet_length(ids) as bigint) div 4").alias("n_tokens"), "ids")


def _encode_long(src: DataFrame, path: str, run_bytes: int) -> DataFrame:
    """``doc_id, ids`` of texts with long unsplit stretches."""

    def dealt(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bpe, uid = coder(path), TaskContext.get().partitionId() << 40
        for batch in parts:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                part, held = 0, []
                for piece, special in bpe.stretches(text):
                    data = piece.encode("utf-8", "surrogatepass")
                    if special is None and len(data) >= run_bytes:
                        if held:
                            yield uid, doc_id, part, 0, 1, True, np.array(held, dtype="<u4").tobytes()
                            part, held = part + 1, []
                        cuts = range(0, len(data), run_bytes)
                        for k, at in enumerate(cuts):
                            yield uid, doc_id, part, k, len(cuts), False, data[at : at + run_bytes]
                        part += 1
                    else:
                        held += [special] if special is not None else bpe.tree(data)
                yield uid, doc_id, part, 0, 1, True, np.array(held, dtype="<u4").tobytes()
                uid += 1

    def leaves(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = coder(path)
        for batch in parts:
            for *keys, done, data in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "done", "data"))):
                yield *keys, data if done else np.array(bpe.tree(data), dtype="<u4").tobytes()

    KEYS = ["uid", "doc_id", "part", "leaf", "leaves"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    schema = "uid long, doc_id long, part int, leaf int, leaves int"
    split = src.mapInArrow(_rows(dealt, [*KEYS, "done", "data"], [*kinds, pa.bool_(), pa.binary()]), f"{schema}, done boolean, data binary")
    split = written(split, "unsplit")
    most = split.agg(F.max("leaves")).first()[0] or 1
    spread = split.repartition(*KEYS[:1], *KEYS[2:4])
    ids = spread.mapInArrow(_rows(leaves, [*KEYS, "ids"], [*kinds, pa.binary()]), f"{schema}, ids binary")

    def joined(two: pd.DataFrame) -> pd.DataFrame:
        two = two.sort_values("leaf")
        out = two.iloc[:1].copy()
        if len(two) == 2:
            left, right = (np.frombuffer(x, dtype="<u4").tolist() for x in two["ids"])
            out["ids"] = [np.array(coder(path).join(left, right), dtype="<u4").tobytes()]
        out["leaf"] //= 2
        return out[[*KEYS, "ids"]]

    while most > 1:
        ids = ids.groupBy("uid", "part", F.floor(F.col("leaf") / 2).alias("half")).applyInPandas(joined, f"{schema}, ids binary")
        most = -(-most // 2)

    def assembled(one: pd.DataFrame) -> pd.DataFrame:
        one = one.sort_values("part")
        return pd.DataFrame({"doc_id": one["doc_id"].iloc[:1], "ids": [b"".join(one["ids"])]})

    return ids.groupBy("uid").applyInPandas(assembled, "doc_id long, ids binary")


def decode(ids: Column, path: str) -> Column:
    """Text of ids as ``encode`` gives them; null for null."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = coder(path)
        for some in parts:
            yield some.map(lambda x: None if x is None else bpe.decode(x))

    return run(ids)
