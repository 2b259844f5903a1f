"""Quality scores from positive-unlabelled learning with the non-negative risk estimator."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import held_out

#: Bound of each of the two learning samples (documents, taken in hash order).
MAX_POSITIVE, MAX_UNLABELLED = 8192, 8192
CUT = 0.7

# byte classes: 0 a-z, 1 A-Z, 2 digit, 3 blank, 4 line end, 5 . and ,, 6 ! and ?, 7 quotes - ; :,
# 8 # * $ % & @ ^ ~ = + _ \, 9 | < >, 10 brackets and /, 11 control, 12 UTF-8 lead, 13 UTF-8 continuation
_CLASSES = 14


def _byte_classes() -> bytes:
    table = [11] * 256
    for k, members in enumerate(
        (
            b"abcdefghijklmnopqrstuvwxyz",
            b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
            b"0123456789",
            b" \t\x0b\x0c",
            b"\n\r",
            b".,",
            b"!?",
            b"\"'`-;:",
            b"#*$%&@^~=+_\\",
            b"|<>",
            b"()[]{}/",
        )
    ):
        for c in members:
            table[c] = k
    return bytes(table[:128] + [13] * 64 + [12] * 64)


_TABLE = _byte_classes()
N_FEATURES = _CLASSES + _CLASSES * _CLASSES + 8


def features(text: bytes) -> np.ndarray:
    """Length-free shape of a whole text: byte-class shares, class-pair shares, word and line repetition."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    if not text:
        return out
    kinds = np.frombuffer(text.translate(_TABLE), dtype=np.uint8)
    one = np.bincount(kinds, minlength=_CLASSES)[:_CLASSES]
    out[:_CLASSES] = np.sqrt(one / len(kinds))
    if len(kinds) > 1:
        pairs = np.bincount(kinds[:-1] * np.uint8(_CLASSES) + kinds[1:], minlength=_CLASSES * _CLASSES)
        out[_CLASSES : _CLASSES * (_CLASSES + 1)] = np.sqrt(pairs / (len(kinds) - 1))
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    if words:
        seen = Counter(words)
        top = seen.most_common(1)[0][1]
        expected = len(words) ** 0.8
        out[-8:] = (
            len(seen) / len(words),
            min(2.0, len(seen) / expected),
            math.sqrt(top / len(words)),
            min(4.0, math.log1p(len(text) / len(words))),
            min(3.0, math.log1p(len(words)) / 4),
            len(set(lines)) / len(lines),
            min(3.0, math.log1p(len(words) / len(lines)) / 2),
            1.0 if len(words) < 20 else 0.0,
        )
    return out


@dataclass
class PuModel:
    """Linear score on standardised features; ``prior`` is the class prior it was fitted with."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 60, seed: int = 7) -> PuModel:
    """Minimise the non-negative PU risk ``prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])``.

    l is the logistic loss.  Where a batch's estimate of the negative part is
    below zero, the step goes against it (it would only come from
    over-fitting the positives).  An empty side gives the constant score
    ``prior``.
    """
    width = N_FEATURES if not len(positive) else positive.shape[1]
    if not len(positive) or not len(unlabelled):
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return PuModel(np.zeros(width), np.ones(width), np.zeros(width), math.log(p / (1 - p)), prior)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 0.02
    xp, xu = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    w, b = np.zeros(width), math.log(max(prior, 1e-3) / max(1 - prior, 1e-3))
    m, v, step = np.zeros(width + 1), np.zeros(width + 1), 0
    batches = max(1, len(xu) // 512)
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs) + 0.001
        for up, uu in zip(np.array_split(rng.permutation(len(xp)), batches), np.array_split(rng.permutation(len(xu)), batches)):
            if not len(up) or not len(uu):
                continue
            p, u = xp[up], xu[uu]
            gp, gu = p @ w + b, u @ w + b
            negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            # derivatives of the losses by the scores
            pos_p = -prior * _sigmoid(-gp) / len(p)
            neg_p, neg_u = -prior * _sigmoid(gp) / len(p), _sigmoid(gu) / len(u)
            if negative >= 0:
                dp, du = pos_p + neg_p, neg_u
            else:
                dp, du = -neg_p, -neg_u
            grad = np.append(dp @ p + du @ u + 1e-4 * w, dp.sum() + du.sum())
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
    return PuModel(mean, scale, w, float(b), prior)


def _feature_bytes(text: Column) -> Column:
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tobytes() for t in texts])

    return run(F.coalesce(text, F.lit("")).cast("binary"))


def learn(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> PuModel:
    """Fit on the learning fold of ``docs`` (doc_id, text) with ``labels`` (doc_id, quality).

    Trusted positives: documents whose labels are all 1; unlabelled: documents
    without a label (where every one has a label: labelled ones, with labels
    unread).  The class prior is the share of positives among the labelled
    ids, over all of them.  Each sample holds at most the given number of
    documents, taken in hash order of doc_id.  Null ids and null labels are
    not learnt from; of rows that repeat an id one counts.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").filter(~held_out(F.col("doc_id")))
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id is not null and quality is not null")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    prior = marks.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    prior = 0.5 if prior is None else min(max(prior, 0.01), 0.99)

    def sample(keys: DataFrame, n: int, kind: str) -> DataFrame:
        return keys.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).withColumn("kind", F.lit(kind))

    positive = sample(ids.join(marks.filter("quality = 1"), "doc_id", "left_semi"), max_positive, "p")
    unlabelled = sample(ids.join(marks, "doc_id", "left_anti"), max_unlabelled, "u")
    if unlabelled.isEmpty():
        unlabelled = sample(ids, max_unlabelled, "u")
    chosen = positive.union(unlabelled)  # bounded by the two parameters, so it may be broadcast
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "kind", _feature_bytes(F.col("text")).alias("x"))
        .groupBy("doc_id", "kind")
        .agg(F.min("x").alias("x"))
        .orderBy("kind", "doc_id")
        .collect()
    )
    sides = {k: [np.frombuffer(r.x, dtype=np.float32) for r in rows if r.kind == k] for k in "pu"}
    p, u = (np.array(sides[k], dtype=np.float64).reshape(-1, N_FEATURES) for k in "pu")
    return fit_nnpu(p, u, prior)


def score(model: PuModel, text: Column) -> Column:
    """Score of every whole text (null: empty); 0 to 1, higher: likelier good."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([features(t) for t in texts], dtype=np.float64)))

    return run(F.coalesce(text, F.lit("")).cast("binary"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """Rows of ``docs`` whose score reaches ``cut``, all columns as they are."""
    return docs.filter(score(learn(docs, labels), F.col("text")) >= cut)
