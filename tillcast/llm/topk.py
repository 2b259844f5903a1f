"""Exact top-k by inner product: columnar branch-and-bound over blocks of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import written

#: Candidates and queries that one task compares; dimensions added before candidates are compacted.
CANDIDATE_BLOCK, QUERY_BLOCK, DIMENSION_BLOCK = 32_768, 1_024, 8
#: About as many candidates give every query its first bound, before the blocks are compared.
SEEDS = 2_048


def integer_vector(embedding: Column) -> Column:
    """floor(64 * x) of every component as double; null if the vector or a component is null or not finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(embedding, lambda x: F.floor(x.cast("double") * 64).cast("long")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vertical layout: one row per dimension; shorter vectors are filled up with zeros."""
    out = np.zeros((width, len(vectors)), dtype=np.int64)
    for k, v in enumerate(vectors):
        out[: len(v), k] = v
    return out


def search_block(
    q_rows, queries: np.ndarray, c_rows, c_ids, candidates: np.ndarray, k: int, floors=None
) -> list[tuple[int, int, int]]:
    """``(place of the query, vec_id, score)`` of each query's k best candidates in the block, its own row excluded.

    ``q_rows``, ``c_rows``: numbers of the rows; ``floors``: a score that k
    candidates are known to reach, for each query, below which none is
    returned.  Dimensions are taken in order of falling mass, a block of them at a time.
    After each block a candidate's score lies within (length of the rest of
    the query) * (length of the rest of the candidate) of its partial sum;
    candidates whose upper bound is below the k-th best lower bound, or the
    query's floor, go, and the survivors' columns are compacted.  Scores of
    the survivors are summed in integers.
    """
    order = np.argsort(-(candidates.astype(float) ** 2).sum(axis=1), kind="stable")
    columns, asked = candidates[order], queries[order]
    vertical, probe = columns.astype(np.float64), asked.astype(np.float64)
    steps = list(range(0, len(order), DIMENSION_BLOCK)) or [0]
    rest_c = [np.sqrt((vertical[s:] ** 2).sum(axis=0)) for s in [*steps[1:], len(order)]]
    rest_q = [np.sqrt((probe[s:] ** 2).sum(axis=0)) for s in [*steps[1:], len(order)]]
    own = {int(v): i for i, v in enumerate(c_rows)}
    everyone = np.arange(len(c_rows))
    floors = np.full(len(q_rows), -np.inf) if floors is None else floors
    out = []
    for j, row in enumerate(q_rows):
        alive = everyone
        if int(row) in own:
            alive = np.delete(everyone, own[int(row)])
        partial = np.zeros(len(alive))
        for b, s in enumerate(steps):
            if len(alive) <= k and floors[j] == -np.inf or not len(alive):
                break
            block = slice(s, s + DIMENSION_BLOCK)
            part = vertical[block] if len(alive) == len(everyone) else vertical[block][:, alive]
            partial = partial + probe[block, j] @ part
            slack = rest_q[b][j] * rest_c[b][alive]
            slack += 1e-9 * (np.abs(partial) + slack + 1)
            bound = floors[j]
            if len(alive) > k:
                lower = partial - slack
                bound = max(bound, np.partition(lower, len(lower) - k)[len(lower) - k])
            stays = partial + slack >= bound
            alive, partial = alive[stays], partial[stays]
        scores = (columns[:, alive] * asked[:, j][:, None]).sum(axis=0)
        best = np.lexsort((c_ids[alive], -scores))[:k]
        out += [(j, int(c_ids[alive[i]]), int(scores[i])) for i in best]
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best candidates among all rows but its own.

    ``vectors``: ``vec_id``, ``v`` (long components, null: takes no part);
    ``is_query``: condition on ``vec_id``.  Ties go to the smaller vec_id.
    Rows without id take no part.  Rows that repeat an id, equal or not, are
    candidates each, and queries each with ranks of their own.  Shorter
    vectors count as ending in zeros; scores must fit a long; an empty table
    gives no rows; other columns are ignored.

    Queries and candidates are dealt to blocks of bounded size by hash of
    their row numbers, and each pair of blocks is one group: neither side is
    ever whole in one task.  A first pass over about ``SEEDS`` candidates
    gives each query a score that k rows reach, which prunes in every block.
    """
    usable = vectors.filter("vec_id is not null and v is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    # numbered as written, so the numbers stay whatever is computed again
    table = written(usable.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = table.filter(is_query)
    size = table.count()
    c_blocks = max(1, -(-size // CANDIDATE_BLOCK))
    q_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def spread(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(q) and len(c):
            width = max(q["v"].map(len).max(), c["v"].map(len).max())
            found = search_block(
                q["row"].to_numpy(), _matrix(q["v"], width), c["row"].to_numpy(), c["vec_id"].to_numpy(), _matrix(c["v"], width), k,
                q["floor"].to_numpy(dtype=float, na_value=-np.inf),
            )
        out = pd.DataFrame(found, columns=["at", "vec_id", "score"]).astype("int64")
        out["query_row"], out["query_id"] = q["row"].to_numpy()[out["at"]], q["vec_id"].to_numpy()[out["at"]]
        return out[["query_row", "query_id", "vec_id", "score"]]

    def best(left: DataFrame, right: DataFrame) -> DataFrame:
        pairs = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
        return pairs.applyInPandas(compare, "query_row long, query_id long, vec_id long, score long")

    left = written(asked.select("row", "vec_id", "v", spread(q_blocks).alias("qb")), "queries")
    seeds = table.filter(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(max(1, size // SEEDS))) == 0)
    first = best(
        left.select("*", F.lit(0).alias("cb"), F.lit(None).cast("double").alias("floor")),
        seeds.select("row", "vec_id", "v", every(q_blocks).alias("qb"), F.lit(0).alias("cb")),
    )
    floors = first.groupBy(F.col("query_row").alias("row")).agg(F.when(F.count("*") == k, F.min("score").cast("double")).alias("floor"))
    found = best(
        left.join(floors, "row", "left").select("*", every(c_blocks).alias("cb")),
        table.select("row", "vec_id", "v", spread(c_blocks).alias("cb"), every(q_blocks).alias("qb")),
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
