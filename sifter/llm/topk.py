"""Exact top-k search: exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integers. Candidates lie in blocks, each turned into postings by
dimension; a query's non-zero components scatter their weighted postings into a dense score array
over the block, one dimension after the other. Each (query block, candidate block) keeps its best
k by partition selection; a final merge by query picks the k best of all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Rows of a candidate block and of a query block: the score array has their product of entries.
CANDIDATES, QUERIES = 8192, 256
#: Queries that meet a candidate block in one task, block by block: candidates are copied once for so
#: many, queries once for each candidate block.
GROUP = 1 << 16


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores, (queries, candidates), of integer rows: term at a time over the dimensions."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for d in range(min(queries.shape[1], candidates.shape[1])):
        asks = np.flatnonzero(queries[:, d])
        posting = np.flatnonzero(candidates[:, d])
        if len(asks) and len(posting):
            scores[np.ix_(asks, posting)] += np.multiply.outer(queries[asks, d], candidates[posting, d])
    return scores


def dense(rows) -> np.ndarray:
    """Rows of differing lengths as one array, short ones filled with zeros."""
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; the k-th score's ties decide
    exactly, as all of them pass the partition."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def top_k(
    vectors: DataFrame,
    queries: str,
    k: int = 10,
    scale: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: per query row its k best among all other rows.

    ``queries`` is an SQL condition on ``vectors``. Components x become floor(scale * x). Vectors
    that are null or hold a null or non-finite component, and rows without an id, take no part. Of
    vectors of different lengths the missing components count as 0; an empty vector scores 0. Rows
    that repeat an id are rows of their own, and a query meets no row of its own id. Sums must fit
    in 64 bits. No query, or no other row: no result rows.
    """
    x = F.col(embedding)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    ints = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    rows = vectors.where(x.isNotNull() & F.col(vec_id).isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("id"), ints.alias("v"), F.expr(queries).alias("asks")
    )
    rows = materialise(rows, "topk-rows")
    total, asking = rows.count(), rows.where("asks").count()
    blocks, groups = max(1, -(-total // CANDIDATES)), max(1, -(-asking // GROUP))
    spread = lambda n: F.pmod(F.xxhash64("id", F.lit(11)), F.lit(n)).cast("int")
    held = rows.select(spread(blocks).alias("block"), "id", "v")
    # queries travel to the candidates' blocks; candidates are copied once a group of queries. The
    # grid of blocks is the exhaustive search's whole work
    held = held.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = rows.where("asks").select(spread(groups).alias("group"), "id", "v")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(ask) and len(have):
            ids, candidates = have["id"].to_numpy(np.int64), dense(have["v"].tolist())
            for i in range(0, len(ask), QUERIES):
                part = ask.iloc[i : i + QUERIES]
                scores = accumulate(dense(part["v"].tolist()), candidates)
                for q, line in zip(part["id"].to_numpy(np.int64), scores):
                    other = np.flatnonzero(ids != q)
                    best = other[select(line[other], ids[other], k)]
                    out.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": line[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    keys = ["group", "block"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    # at most k rows a query and block meet here
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
