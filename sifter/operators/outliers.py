"""Outlier removal (N1, N2): domain rule union isolation forest, then anti-join.

Isolation forest on Spark (no built-in):

1. every tree draws its ``sample_size`` rows from all rows, by the smallest
   hashes of (key, tree): samples of trees overlap, do not depend on
   partitioning, and in all about twice ``trees * sample_size`` rows are moved;
2. ``applyInPandas`` per tree id grows one isolation tree (numpy) from at most
   ``sample_size`` rows; output = node table (<= 2 * sample_size rows per tree);
3. the forest (bounded: trees x 2 * sample_size nodes) is collected once and
   broadcast; ``mapInPandas`` scores every row with vectorized traversal;
4. the threshold is the exact (1 - contamination) quantile of the scores from
   the distributed quantile primitive - no driver-side sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.operators.impute import column_medians
from sifter.operators.joins import remove_keys, union_keys
from sifter.operators.ranks import exact_quantiles, measured

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size long"


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(tree_id: int, x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([tree_id, me, -1, 0.0, -1, -1, int(len(idx))])
        if depth >= limit or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            return me
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        left = idx[sub[:, f] < t]
        right = idx[sub[:, f] >= t]
        nodes[me][2], nodes[me][3] = f, t
        nodes[me][4] = build(left, depth + 1)
        nodes[me][5] = build(right, depth + 1)
        return me

    build(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


def _path_lengths(x: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    feat, thr, left, right, rest = tree
    cur = np.zeros(len(x), dtype=np.int64)
    depth = np.zeros(len(x), dtype=np.float64)
    i = np.flatnonzero(feat[cur] >= 0)
    while len(i):
        at = cur[i]
        at = np.where(x[i, feat[at]] < thr[at], left[at], right[at])
        cur[i] = at
        depth[i] += 1
        i = i[feat[at] >= 0]
    return depth + rest[cur]


class IsolationForest:
    def __init__(self, cols: Sequence[str], trees: int = 100, sample_size: int = 256,
                 contamination: float = 0.01, seed: int = 42):
        self.cols = list(cols)
        self.trees = trees
        self.sample_size = sample_size
        self.contamination = contamination
        self.seed = seed
        self.forest: pd.DataFrame | None = None
        self.medians: dict = {}
        self.threshold: float | None = None
        self._fit_df: DataFrame | None = None
        self._scores: DataFrame | None = None

    def _features(self, df: DataFrame, key: str) -> DataFrame:
        return df.select(
            key, *[F.coalesce(F.col(c).cast("double"), F.lit(self.medians.get(c) or 0.0)).alias(f"_x{i}")
              for i, c in enumerate(self.cols)]
        )

    def tree_samples(self, df: DataFrame, key: str) -> tuple[DataFrame, int]:
        """``(tree, lot, features)``: for every tree the rows that may be in its
        sample, and the sample size.  A row's lot in a tree is a hash of its key,
        so samples of different trees overlap and no partitioning changes them;
        rows with lots below twice the wanted share (and some more) pass, and a
        tree takes its ``sample_size`` smallest."""
        n = df.count()
        psi = min(self.sample_size, n)
        share = min(1.0, (2.0 * psi + 64) / max(n, 1))
        lots = F.transform(
            F.sequence(F.lit(0), F.lit(self.trees - 1)),
            lambda t: F.struct(
                t.alias("tree"), (F.xxhash64(F.col("_key"), t, F.lit(self.seed)) / F.lit(2.0**64) + 0.5).alias("lot")
            ),
        )
        feats = self._features(df, key).withColumnRenamed(key, "_key")
        feats = feats.withColumn("_lot", F.explode(F.filter(lots, lambda x: x["lot"] <= share)))
        return feats.select("_lot.tree", "_lot.lot", *[f"_x{i}" for i in range(len(self.cols))]), psi

    def fit(self, df: DataFrame, key: str) -> "IsolationForest":
        self.medians = column_medians(df, self.cols)
        feats, psi = self.tree_samples(df, key)
        limit = int(math.ceil(math.log2(max(psi, 2))))
        names, seed = [f"_x{i}" for i in range(len(self.cols))], self.seed

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            t = int(pdf["tree"].iloc[0])
            rng = np.random.default_rng(seed + t)
            x = pdf.sort_values(["lot", *names])[names].to_numpy(dtype=np.float64)[:psi]
            return pd.DataFrame(_grow(t, x, rng, limit), columns=["tree", "node", "feature", "threshold", "left", "right", "size"])

        self.forest = feats.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas().sort_values(["tree", "node"])
        self.psi = psi
        # score the fitted rows once; the written scores serve both the
        # threshold and the flags of these rows
        self._fit_df = df
        self._scores = measured(self.score(df, key), "forest-scores")
        q = exact_quantiles(self._scores, "score", [1 - self.contamination]).first()
        self.threshold = q["q"]
        return self

    def score(self, df: DataFrame, key: str) -> DataFrame:
        bc = df.sparkSession.sparkContext.broadcast(self.forest)
        p, psi = len(self.cols), self.psi
        cnorm = _c(psi)

        def run(batches):
            forest = bc.value
            groups = []
            for _, g in forest.sort_values(["tree", "node"]).groupby("tree"):
                rest = np.array([_c(size) for size in g["size"]])  # of a node once, not of a row
                groups.append((*(g[c].to_numpy() for c in ("feature", "threshold", "left", "right")), rest))
            for pdf in batches:
                x = pdf[[f"_x{i}" for i in range(p)]].to_numpy(dtype=np.float64)
                total = np.zeros(len(x))
                for g in groups:
                    total += _path_lengths(x, g)
                mean = total / max(len(groups), 1)
                yield pd.DataFrame({key: pdf[key].to_numpy(), "score": np.power(2.0, -mean / cnorm)})

        feats = self._features(df, key)
        key_type = df.schema[key].dataType
        schema = T.StructType([T.StructField(key, key_type), T.StructField("score", T.DoubleType())])
        return feats.mapInPandas(run, schema)

    def outliers(self, df: DataFrame, key: str) -> DataFrame:
        s = self._scores if df is self._fit_df else self.score(df, key)
        return s.withColumn("is_outlier", (F.col("score") > F.lit(self.threshold)).cast("int"))


def remove_outliers(df: DataFrame, key: str, rule, forest: IsolationForest | None = None) -> DataFrame:
    """Drop rows matching the domain rule (null comparisons are false) or
    flagged by the forest (union of key sets, then anti-join)."""
    rule_keys = df.where(F.coalesce(rule, F.lit(False))).select(key)
    keys = rule_keys
    if forest is not None:
        flagged = forest.outliers(df, key).where(F.col("is_outlier") == 1).select(key)
        keys = union_keys(rule_keys, flagged)
    return remove_keys(df, keys, key)
