"""Models and validation.

* Folds and hold-out come from a stable hash of the row key
  (``lot_of``): independent of partitioning and row order.
* Boosted trees are grown by ``boosting``, on ``log1p(target)``; a plain numpy
  version of the same trees checks them.
* Ridge: exact normal equations (Spark ML weighted least squares: X'X is
  aggregated over the cluster, the p x p solve is small).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.functions.exprs import SEGMENT_LABEL
from sifter.operators.boosting import PATIENCE, Boosted, boost, predict_left_out
from sifter.operators.features import standardize
from sifter.operators.ranks import measured


def lot_of(key: str, seed: int, n: int):
    """A number from 0 to n - 1 by the md5 of "key:seed", so other engines deal alike."""
    text = F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def fold_of(key: str, k: int, seed: int = 42):
    return lot_of(key, seed, k)


def holdout(df: DataFrame, key: str, test_fraction: float = 0.1, seed: int = 42, buckets: int = 1000):
    """Deterministic hash split -> (train, test)."""
    b = lot_of(key, seed + 1, buckets)
    cut = int(round(test_fraction * buckets))
    return df.where(b >= cut), df.where(b < cut)


# ---- N3 k-means segments ----------------------------------------------------------------
#: Rows that starting centroids are drawn from: those with the smallest hashes of the key.
START_ROWS = 4000


def _spread(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k starting points, each drawn by its squared distance to those before it."""
    chosen = [x[rng.integers(len(x))]]
    far = ((x - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = far.sum()
        chosen.append(x[rng.choice(len(x), p=far / total)] if total > 0 else x[rng.integers(len(x))])
        far = np.minimum(far, ((x - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the nearest centroid (the first of equals) and its squared distance."""
    far = (x * x).sum(axis=1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(axis=1)
    best = far.argmin(axis=1)
    return best, np.maximum(far[np.arange(len(x)), best], 0.0)


def kmeans(rows: DataFrame, k: int, seed: int, n_init: int, rounds: int = 20, tol: float = 1e-4) -> tuple[np.ndarray, float]:
    """Centroids of the cheapest of ``n_init`` runs and their cost, from column ``x`` (array<double>)
    and ``hash`` of ``rows``.

    All runs share every scan: a task assigns its rows to the centroids of all runs and sends one row
    a run, their sums, counts and cost. A run rests once no centroid moves by more than ``tol``."""
    start = np.array([r["x"] for r in rows.orderBy("hash", "x").select("x").limit(START_ROWS).collect()], float)
    if not len(start):
        return np.zeros((0, 0)), 0.0
    width = start.shape[1]
    centers = [_spread(start, k, np.random.default_rng([seed, i])) for i in range(n_init)]
    moving, costs = list(range(n_init)), [math.inf] * n_init

    for turn in range(rounds + 1):
        sent = {i: centers[i] for i in moving}

        def run(batches):
            sums = {i: np.zeros((k, width + 1)) for i in sent}
            cost = dict.fromkeys(sent, 0.0)
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                for i, own in sent.items():
                    best, far = _nearest(x, own)
                    hot = np.zeros((len(x), k))
                    hot[np.arange(len(x)), best] = 1.0
                    sums[i][:, :width] += hot.T @ x
                    sums[i][:, width] += hot.sum(axis=0)
                    cost[i] += far.sum()
            flat = [sums[i].ravel().tolist() for i in sent]
            yield pa.RecordBatch.from_arrays([pa.array(list(sent), pa.int32()), pa.array(flat, pa.list_(pa.float64())), pa.array(list(cost.values()), pa.float64())], names=["run", "sums", "cost"])

        parts = rows.select("x").mapInArrow(run, "run int, sums array<double>, cost double")
        cells = parts.select("run", "cost", F.posexplode("sums").alias("at", "v"))
        added = cells.groupBy("run", "at").agg(F.sum("v").alias("v"), F.sum("cost").alias("cost")).collect()
        totals = {i: np.zeros(k * (width + 1)) for i in moving}
        for r in added:
            totals[r["run"]][r["at"]] = r["v"]
            costs[r["run"]] = r["cost"]
        still = []
        for i in moving:
            got = totals[i].reshape(k, width + 1)
            new = np.where(got[:, width:] > 0, got[:, :width] / np.maximum(got[:, width:], 1), centers[i])
            moved = np.sqrt(((new - centers[i]) ** 2).sum(axis=1)).max()
            if moved > tol and turn < rounds:
                centers[i] = new
                still.append(i)
        moving = still
        if not moving:
            break
    best = min(range(n_init), key=lambda i: (costs[i], i))
    return centers[best], costs[best]


def kmeans_segments(
    df: DataFrame, key: str, cols: Sequence[str], k: int = 5, seed: int = 42, n_init: int = 10, out_col: str = "MarketSegment"
) -> DataFrame:
    """Zero-fill, population-std standardization, k-means (best of ``n_init``
    runs by cost); segment numbers follow the centroid order, since cluster ids
    are arbitrary. Rows far fewer than ``k`` share centroids; an empty table gives no rows."""
    z = standardize(df.select(key, *cols), list(cols), fill=0.0)
    rows = measured(z.select(key, F.xxhash64(key).alias("hash"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x")), "kmeans-rows")
    centers, _ = kmeans(rows, k, seed, n_init)
    if not len(centers):
        return rows.select(key, F.lit(None).cast("string").alias(out_col))
    centers = np.array(sorted(map(tuple, centers.tolist())))

    def assign(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, centers.shape[1])
            best, _ = _nearest(x, centers)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(best.astype(np.int32))], names=["key", "cluster"])

    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("cluster", T.IntegerType())])
    found = rows.select(F.col(key).alias("key"), "x").mapInArrow(assign, schema)
    labels = F.array(*[F.lit(SEGMENT_LABEL.format(i=i)) for i in range(k)])
    return found.select(F.col("key").alias(key), F.element_at(labels, F.col("cluster") + 1).alias(out_col))


# ---- N4-N9 boosted trees -------------------------------------------------------------------
def fit_trees(
    df: DataFrame, key: str, target: str, numeric: Sequence[str], categorical: Sequence[str],
    validation_col: str | None = None, patience: int = PATIENCE, **kw,
) -> Boosted:
    """N4/N7 on the log target. With a boolean ``validation_col`` those rows are left out of the
    fit, which ends ``patience`` rounds after their least error and keeps the trees up to it."""
    own = {} if validation_col is None else {"lot": F.col(validation_col).cast("int"), "held": [1], "patience": patience}
    return boost(df, key, F.log1p(F.col(target)), numeric, categorical, **own, **kw)[0]


def regression_scores(pred: DataFrame, label: str, prediction: str) -> dict:
    """r2 / rmse / mae on the log scale (one aggregation)."""
    r = F.col(label) - F.col(prediction)
    row = pred.agg(
        (1 - F.try_divide(F.sum(r * r), F.count(label) * F.var_pop(label))).alias("r2"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(F.abs(r)).alias("mae"),
    ).first()
    return {"r2": row["r2"], "rmse": row["rmse"], "mae": row["mae"]}


def cross_validate(
    df: DataFrame, key: str, target: str, numeric: Sequence[str], categorical: Sequence[str], folds: int = 10, seed: int = 42, **kw
) -> DataFrame:
    """Per-fold r2/rmse/mae of the log target; every row is in one fold and scored by the fit
    that left it out. The folds' fits share every pass over the rows. A row without a key is in no
    fold: all fits learn from it, none scores it."""
    df = df.withColumn("_fold", fold_of(key, folds, seed)).withColumn("_label", F.log1p(F.col(target))).where(F.col("_label").isNotNull())
    fits = boost(df, key, F.col("_label"), numeric, categorical, lot=F.col("_fold"), held=range(folds), seed=seed, **kw)
    scored = predict_left_out(fits, range(folds))
    r = F.col("label") - F.col("pred_log")
    n = F.count(F.lit(1))
    return scored.groupBy(F.col("lot").alias("fold")).agg(
        n.alias("n"), (1 - F.try_divide(F.sum(r * r), n * F.var_pop("label"))).alias("r2"),
        F.sqrt(F.avg(r * r)).alias("rmse"), F.avg(F.abs(r)).alias("mae"),
    )


# ---- N10 ridge ----------------------------------------------------------------------------
def ridge_fit(df: DataFrame, target: str, cols: Sequence[str], alpha: float = 1.0) -> DataFrame:
    """Scikit-learn ``Ridge(alpha)`` after ``StandardScaler`` (population std):
    exact normal equations through Spark ML's weighted least squares
    (``solver="normal"``, X'X aggregated over the cluster; p <= 4096) on the
    already standardized features."""
    z = standardize(df.select(target, *cols), list(cols), fill=0.0).where(F.col(target).isNotNull())
    st = z.agg(F.count(target).alias("n"), F.stddev_pop(target).alias("sy")).first()
    n, sy = st["n"], st["sy"] or 1.0
    va = VectorAssembler(inputCols=list(cols), outputCol="_features")
    # the solver standardizes the label and applies regParam / std(y) (glmnet
    # convention): regParam = alpha * std(y) / n gives scikit-learn's penalty
    lr = LinearRegression(
        featuresCol="_features", labelCol=target, solver="normal", regParam=alpha * sy / n,
        elasticNetParam=0.0, standardization=False, fitIntercept=True,
    )
    model = lr.fit(va.transform(z))
    rows = [(c, float(v)) for c, v in zip(cols, model.coefficients.toArray())] + [("(intercept)", float(model.intercept))]
    return df.sparkSession.createDataFrame(rows, "feature string, coef double")


__all__ = [
    "cross_validate", "fit_trees", "fold_of", "holdout", "kmeans_segments",
    "regression_scores", "ridge_fit",
]
