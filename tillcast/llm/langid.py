"""Language identification by unigram piece models that sum over all segmentations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import held_out

UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"  # marks the start of a word in the vocabulary
_HASH = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS = 400_000
_COUNTED_WORDS = 300_000
_AT_ONCE = 1 << 15
_LONGEST = 64
_GROUP_WORDS = 300_000


def words_of(text: str | None) -> list[str]:
    """Lower-case letter runs of a whole text; runs over ``_LONGEST`` letters count as several words."""
    words = LETTERS.findall(text.lower()) if text else []
    if words and max(map(len, words)) > _LONGEST:
        words = [w[i : i + _LONGEST] for w in words for i in range(0, len(w), _LONGEST)]
    return words


def _by_length(words: Iterable[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    for some in groups.values():
        for at in range(0, len(some), _AT_ONCE):
            yield some[at : at + _AT_ONCE]


@dataclass
class Pieces:
    """The public vocabulary as look-up tables: by length, sorted hashes of the pieces and their numbers."""

    tables: dict[int, tuple[np.ndarray, np.ndarray]]
    n_pieces: int  # letter pieces, then 256 byte pieces

    @classmethod
    def read(cls, path: str) -> "Pieces":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = sorted(
            {
                t
                for t in (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
                if (core := t.removeprefix(_START)) == "" and t or LETTERS.fullmatch(core) and core == core.lower()
            }
        )
        by_length: dict[int, list[tuple[int, int]]] = {}
        for number, t in enumerate(texts):
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in t:
                    h = h * _HASH + np.uint64(ord(c))
            by_length.setdefault(len(t), []).append((int(h), number))
        tables = {}
        for k, pairs in by_length.items():
            pairs.sort()
            tables[k] = (np.array([h for h, _ in pairs], dtype=np.uint64), np.array([n for _, n in pairs], dtype=np.int64))
        return cls(tables, len(texts))

    @property
    def size(self) -> int:
        return self.n_pieces + 256

    def lattice(self, words: list[str]) -> tuple[int, dict, dict]:
        """For words of one length: the marked length; by (end, piece length) the piece numbers (-1: none);
        by end the bytes of the characters that have no piece."""
        width = len(words[0]) + 1
        flat = np.frombuffer("".join(_START + w for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = flat.reshape(len(words), width).T.astype(np.uint64)
        edges: dict[tuple[int, int], np.ndarray] = {}
        with np.errstate(over="ignore"):
            rolling = np.zeros_like(codes)  # hash of the k characters that end at each place
            for k in range(1, min(width, max(self.tables)) + 1):
                rolling = np.vstack([np.zeros((1, len(words)), dtype=np.uint64), rolling[:-1]]) * _HASH + codes
                if k not in self.tables:
                    continue
                known, numbers = self.tables[k]
                for end in range(k, width + 1):
                    at = np.minimum(np.searchsorted(known, rolling[end - 1]), len(known) - 1)
                    hit = known[at] == rolling[end - 1]
                    if hit.any():
                        edges[end, k] = np.where(hit, numbers[at], -1)
        spelled = {}
        for end in range(1, width + 1):
            lone = np.flatnonzero(edges[end, 1] < 0) if (end, 1) in edges else np.arange(len(words))
            if len(lone):
                spelled[end] = [(int(w), list(chr(int(codes[end - 1, w])).encode("utf-8", "replace"))) for w in lone]
        return width, edges, spelled


@dataclass
class LanguageModel:
    """Piece probabilities per language (rows: pieces and bytes; columns: languages) and log priors."""

    pieces: Pieces
    languages: list[str]
    probability: np.ndarray
    log_prior: np.ndarray
    _rows: dict[str, int] = field(default_factory=dict)
    _scores: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_rows": {}, "_scores": None}

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of every word in every language, by the forward algorithm over all segmentations."""
        place = {w: i for i, w in enumerate(words)}
        out = np.zeros((len(words), len(self.languages)))
        for some in _by_length(words):
            out[[place[w] for w in some]] = self._forward(some)
        return out

    def _forward(self, words: list[str]) -> np.ndarray:
        width, edges, spelled = self.pieces.lattice(words)
        table = np.vstack([self.probability, np.zeros(len(self.languages))])  # -1: no piece
        logs = [np.zeros((len(words), len(self.languages)))]  # log of the sum over segmentations of each prefix
        for end in range(1, width + 1):
            total = np.zeros_like(logs[0])
            for k in range(1, end + 1):
                if (end, k) in edges:
                    total += table[edges[end, k]] * (1 if k == 1 else np.exp(logs[end - k] - logs[end - 1]))
            for w, octets in spelled.get(end, ()):
                total[w] += self.probability[self.pieces.n_pieces + np.array(octets)].prod(axis=0)
            logs.append(logs[end - 1] + np.log(total))
        return logs[width]

    def classify(self, text: str | None) -> tuple[str, float]:
        """Language with the highest posterior, and the posterior."""
        return self.classify_words(words_of(text))

    def classify_words(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        total = self.log_prior.copy()
        for at in range(0, len(words), _CACHED_WORDS // 4):
            total += self._summed(words[at : at + _CACHED_WORDS // 4])
        odds = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.languages[best], float(odds[best] / odds.sum())

    def classify_all(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float]]:
        """``classify`` for many texts; the new words of a group of texts are scored together."""
        group: list[list[str]] = []
        held = 0
        for text in texts:
            group.append(words_of(text))
            held += len(group[-1])
            if held > _GROUP_WORDS:
                self.learn_words(set().union(*group))
                yield from map(self.classify_words, group)
                group, held = [], 0
        self.learn_words(set().union(*group))
        yield from map(self.classify_words, group)

    def learn_words(self, words: set[str]) -> None:
        new = [w for w in words if w not in self._rows]
        if not new:
            return
        if len(self._rows) + len(new) > _CACHED_WORDS:
            self._rows, self._scores = {}, None
            new = list(words)
        scores = self.word_scores(new)
        at = len(self._rows)
        need = at + len(new)
        if self._scores is None or need > len(self._scores):
            grown = np.zeros((max(2 * need, 1 << 14), len(self.languages)))
            if self._scores is not None:
                grown[:at] = self._scores[:at]
            self._scores = grown
        self._scores[at:need] = scores
        self._rows.update(zip(new, range(at, need)))

    def _summed(self, words: list[str]) -> np.ndarray:
        rows = list(map(self._rows.get, words))
        if None in rows:
            self.learn_words(set(words))
            rows = list(map(self._rows.__getitem__, words))
        return self._scores[rows].sum(axis=0)


def expected_counts(pieces: Pieces, counted: dict[str, Counter]) -> dict[str, np.ndarray]:
    """Expected piece counts per language, every segmentation weighted by equally probable pieces."""
    out = {lang: np.zeros(pieces.size) for lang in counted}
    log_p = -np.log(pieces.size)
    p = np.exp(log_p)
    for words in _by_length(set().union(*counted.values())):
        width, edges, spelled = pieces.lattice(words)
        lone = {e: np.zeros(len(words)) for e in spelled}
        for e, some in spelled.items():
            for w, octets in some:
                lone[e][w] = p ** len(octets)

        def ways(e: int, k: int) -> np.ndarray | float:
            """Probability of the piece of length k that ends at e."""
            there = (edges[e, k] >= 0) * p if (e, k) in edges else 0.0
            return there + lone[e] if k == 1 and e in lone else there

        before = [np.zeros(len(words))]  # log of the sum over segmentations of what ends here
        for e in range(1, width + 1):
            total = sum(ways(e, k) * np.exp(before[e - k] - before[e - 1]) for k in range(1, e + 1) if k == 1 or (e, k) in edges)
            before.append(before[e - 1] + np.log(total))
        after = [np.zeros(len(words))] * (width + 1)  # and of what begins here
        for e in range(width - 1, -1, -1):
            total = sum(
                ways(e + k, k) * np.exp(after[e + k] - after[e + 1]) for k in range(1, width - e + 1) if k == 1 or (e + k, k) in edges
            )
            after[e] = after[e + 1] + np.log(total)
        weights = {lang: np.array([c[w] for w in words], dtype=float) for lang, c in counted.items()}
        for (e, k), ids in edges.items():
            rows = np.flatnonzero(ids >= 0)
            share = np.exp(before[e - k][rows] + after[e][rows] + log_p - after[0][rows])
            for lang, n in weights.items():
                out[lang] += np.bincount(ids[rows], share * n[rows], minlength=pieces.size)
        for e, some in spelled.items():
            share = np.exp(before[e - 1] + after[e] - after[0]) * lone[e]
            for w, octets in some:
                for lang, n in weights.items():
                    np.add.at(out[lang], pieces.n_pieces + np.array(octets), share[w] * n[w])
    return out


def learn(docs: DataFrame, vocabulary_path: str, smoothing: float = 0.05) -> LanguageModel:
    """Piece probabilities per language from the learning fold of ``docs`` (doc_id, text, lang).

    All its documents with a language count; what reaches the driver is one
    number per language and piece of the fixed vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.read(vocabulary_path)
        counted: dict[str, Counter] = {}
        sums: dict[str, np.ndarray] = {}

        def flush() -> None:
            for lang, x in expected_counts(pieces, counted).items():
                sums[lang] = sums.get(lang, 0) + x
            counted.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                counted.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counted.values())) > _COUNTED_WORDS:
                flush()
        flush()
        for lang, x in sums.items():
            rows = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows)), pa.array(rows.astype(np.int32)), pa.array(x[rows])], names=["lang", "piece", "n"]
            )

    fold = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).filter(~held_out(F.col("doc_id")))
    sums = (
        fold.select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(run, "lang string, piece int, n double")
        .groupBy("lang", "piece")
        .agg(F.sum("n").alias("n"))
    )
    shares = {r.lang: r["count"] for r in fold.groupBy(F.col("lang").cast("string").alias("lang")).count().collect()}
    pieces = Pieces.read(vocabulary_path)
    languages = sorted(shares)
    counts = np.full((pieces.size, len(languages)), smoothing)
    column = {lang: k for k, lang in enumerate(languages)}
    for r in sums.toLocalIterator():
        counts[r.piece, column[r.lang]] += r.n
    prior = np.array([shares[x] for x in languages], dtype=float)
    return LanguageModel(pieces, languages, counts / counts.sum(axis=0), np.log(prior / prior.sum()) if languages else prior)


def predict(model: LanguageModel, text: Column) -> Column:
    """Struct ``lang_pred, score`` of every whole text; ``und`` and 0 for null texts and texts without a letter."""

    @F.pandas_udf("lang_pred string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame(list(model.classify_all(texts)), columns=["lang_pred", "score"])

    return run(text)
