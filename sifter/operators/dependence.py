"""Dependence measures (H1-H6).

* Pearson: every pair in one aggregation (``corr`` ignores rows where either
  side is null = pandas' pairwise-complete rule).
* Spearman: average ranks (ties share the mean rank) then Pearson, both over the
  rows where the two columns are present.  Counts of distinct value pairs stand
  for the rows, so ranks join on tables of distinct values - no global window.
* Mutual information: a plug-in estimate on bins (by rank for numbers, so a heavy
  value has a bin of its own; categories for text): joint counts from one grouped
  aggregation, then H(X) + H(Y) - H(X,Y) from sums over joint and marginal counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sifter.operators.binning import quantile_edges
from sifter.operators.profile import group_stats
from sifter.operators.ranks import average_ranks, exact_quantiles, measured, order_statistics
from sifter.functions.exprs import bin_index, safe_corr


def pearson_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H1: long matrix ``(col_i, col_j, r)`` incl. the unit diagonal."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    agg = df.agg(*[safe_corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    cells = []
    for k, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"), F.col(f"r{k}").alias("r")))
        cells.append(F.struct(F.lit(b).alias("col_i"), F.lit(a).alias("col_j"), F.col(f"r{k}").alias("r")))
    for c in cols:
        cells.append(F.struct(F.lit(c).alias("col_i"), F.lit(c).alias("col_j"), F.lit(1.0).alias("r")))
    return agg.select(F.inline(F.array(*cells)))


#: Columns of a block of the Gram matrices, parts a block's sums are first added up in.
BLOCK, SALT = 64, 16


def pearson_wide(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """H1 for many columns: ``pearson_long`` from blocked Gram matrices with presence masks.

    With X the centred columns, 0 where null, and M their presence, all pairs' sums over the rows
    where both are present are products of blocks: counts M'M, sums X'M, squares (X*X)'M and products
    X'X. A task adds up its own blocks; they are then added up in SALT parts each and in one, so no
    task gets more than its share of blocks. The result has a row a pair, null where a side is constant."""
    cols = list(cols)
    n = len(cols)
    blocks = [(a, min(a + block, n)) for a in range(0, n, block)]
    part = F.spark_partition_id() % SALT
    rows = df.select(part.alias("part"), F.array(*[F.col(c).cast("double") for c in cols]).cast("array<double>").alias("x"))

    def unpacked(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n)

    def first_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, 2))
        for batch in batches:
            x = unpacked(batch)
            total += np.stack([np.nansum(x, axis=0), (~np.isnan(x)).sum(axis=0)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["i", "s", "n"])

    means = np.zeros(n)
    for r in rows.mapInArrow(first_sums, "i int, s double, n double").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():
        means[r["i"]] = r["s"] / r["n"] if r["n"] else 0.0
    kinds = "bi int, bj int, part int, sums binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        salt = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            salt = batch.column("part")[0].as_py()
            x = unpacked(batch) - means
            m = ~np.isnan(x)
            x, m = np.where(m, x, 0.0), m.astype(float)
            for i, (a, b) in enumerate(blocks):
                for j, (c, d) in enumerate(blocks[i:], i):
                    xi, mi, xj, mj = x[:, a:b], m[:, a:b], x[:, c:d], m[:, c:d]
                    got = np.stack([mi.T @ mj, xi.T @ mj, mi.T @ xj, (xi * xi).T @ mj, mi.T @ (xj * xj), xi.T @ xj])
                    total[i, j] = total[i, j] + got if (i, j) in total else got
        if total:
            keys = list(total)
            columns = [[i for i, _ in keys], [j for _, j in keys], [salt] * len(keys)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int32()) for c in columns), pa.array([total[k].tobytes() for k in keys], pa.binary())], names=["bi", "bj", "part", "sums"]
            )

    def add(table: pa.Table) -> pa.Table:
        sums = table.column("sums")
        out = sum(np.frombuffer(x.as_buffer(), np.float64) for x in sums)
        head_ = [table.column(c).slice(0, 1).combine_chunks() for c in ("bi", "bj", "part")]
        return pa.table([*head_, pa.array([out.tobytes()], pa.binary())], names=["bi", "bj", "part", "sums"])

    def finish_(table: pa.Table) -> pa.Table:
        (a, b), (c, d) = (blocks[table.column(k)[0].as_py()] for k in ("bi", "bj"))
        sums = sum(np.frombuffer(x.as_buffer(), np.float64) for x in table.column("sums"))
        k, si, sj, qi, qj, p = sums.reshape(6, b - a, d - c)
        with np.errstate(all="ignore"):
            vi, vj = qi - si * si / k, qj - sj * sj / k
            r = (p - si * sj / k) / np.sqrt(vi) / np.sqrt(vj)
            r[(k < 2) | (vi <= 1e-14 * qi) | (vj <= 1e-14 * qj)] = np.nan
        i, j = (x.ravel() for x in np.meshgrid(np.arange(a, b), np.arange(c, d), indexing="ij"))
        keep = i < j
        flat = np.clip(r.ravel()[keep], -1, 1)
        return pa.table([pa.array(i[keep], pa.int32()), pa.array(j[keep], pa.int32()), pa.array(flat, from_pandas=True)], names=["i", "j", "r"])

    sums = rows.mapInArrow(run, kinds).groupBy("bi", "bj", "part").applyInArrow(add, kinds)
    found = sums.groupBy("bi", "bj").applyInArrow(finish_, "i int, j int, r double")
    names = F.array(*[F.lit(c) for c in cols])
    name = lambda c: F.element_at(names, F.col(c) + 1)
    ways = F.array(*[F.struct(name(a).alias("col_i"), name(b).alias("col_j"), F.col("r")) for a, b in (("i", "j"), ("j", "i"))])
    own = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_i string, col_j string, r double")
    return found.select(F.inline(ways)).unionByName(own)


def rank_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(col_i, col_j, rho)``: Spearman of each pair over the rows where both
    columns are present (pandas' rule), null if a side is constant.

    The rows are counted by (pair, x, y) once; ranks are those of the counted
    table's margins, joined back on (pair, value)."""
    cells = F.array(*[
        F.struct(F.lit(k).alias("pair"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
        for k, (a, b) in enumerate(pairs)
    ])
    joint = df.select(F.inline(cells)).where("x is not null and y is not null").groupBy("pair", "x", "y").agg(
        F.count(F.lit(1)).alias("c")
    )
    joint = measured(joint, "rank-pairs")
    for side in "xy":
        # a value occurs as often as its cells say; the two sides are ranked by themselves
        weighted = joint.groupBy("pair", side).agg(F.sum("c").alias("_n"))
        ranks = average_ranks(weighted, side, ["pair"], weight="_n").withColumnRenamed("avg_rank", f"r{side}")
        # written, so that its true size plans the join: few values leave the cells where they are
        joint = joint.join(measured(ranks, "ranks"), ["pair", side])
    c, x, y = F.col("c").cast("double"), F.col("rx"), F.col("ry")
    sums = joint.groupBy("pair").agg(
        F.sum(c).alias("n"), F.sum(c * x).alias("sx"), F.sum(c * y).alias("sy"),
        F.sum(c * x * x).alias("sxx"), F.sum(c * y * y).alias("syy"), F.sum(c * x * y).alias("sxy"),
    )
    n = F.col("n")
    rho = F.try_divide(
        F.expr("sxy - sx * sy / n"),
        F.sqrt(F.greatest(F.expr("sxx - sx * sx / n"), F.lit(0.0))) * F.sqrt(F.greatest(F.expr("syy - sy * sy / n"), F.lit(0.0))),
    )
    name = [F.element_at(F.array(*[F.lit(p[s]) for p in pairs]), F.col("pair") + 1) for s in (0, 1)]
    return sums.where(n > 0).select(name[0].alias("col_i"), name[1].alias("col_j"), rho.alias("rho"))


def spearman_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H2: long matrix ``(col_i, col_j, r)`` incl. the unit diagonal."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    ways = F.array(*[F.struct(F.col(a).alias("col_i"), F.col(b).alias("col_j"), F.col("rho").alias("r")) for a, b in (("col_i", "col_j"), ("col_j", "col_i"))])
    rho = rank_correlations(df, pairs).select(F.inline(ways))
    return df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_i string, col_j string, r double").unionByName(rho)


def target_correlations(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """H3 input: ``(feature, pearson, spearman)`` of every column vs the target,
    each over the rows where both are present."""
    cols = [c for c in dict.fromkeys(cols) if c != target]
    p = df.agg(*[safe_corr(c, target).alias(f"p{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"p{i}").alias("pearson")) for i, c in enumerate(cols)]
    pearson = p.select(F.inline(F.array(*cells)))
    rho = rank_correlations(df, [(c, target) for c in cols]).select(F.col("col_i").alias("feature"), F.col("rho").alias("spearman"))
    own = df.sparkSession.createDataFrame([(target, 1.0, 1.0)], "feature string, pearson double, spearman double")
    return pearson.join(rho, "feature", "left").unionByName(own)


def top_by_abs(corr: DataFrame, col: str, n: int) -> DataFrame:
    """H3: first ``n`` features by |r| (ties by name)."""
    return corr.orderBy(F.abs(F.col(col)).desc(), F.col("feature")).limit(n)


def relation_report(df: DataFrame, target: str, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """H5: ``feature, segment, pearson, spearman, mean, median, std, count, rank``.
    A number has its correlations and target statistics by quartile (repeated
    edges merged), in the order of the quartiles; a text column target
    statistics by category, highest mean first.  The columns are written once."""
    rows = measured(df.select(F.col(target).cast("double").alias(target), *numeric, *text), "relations")
    edges = quantile_edges(rows, list(numeric), 4)
    cells = [
        F.struct(F.lit(c).alias("feature"), bin_index(F.col(c).cast("double"), sorted(set(edges[c]))[1:-1]).cast("string").alias("segment"))
        for c in numeric
        if edges[c][0] is not None
    ]
    cells += [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("segment")) for c in text]
    long = rows.select(target, F.inline(F.array(*cells)))
    stats = group_stats(long, ["feature", "segment"], target)
    corr = target_correlations(rows, target, list(numeric)).where(F.col("feature") != target)
    out = stats.join(F.broadcast(corr), "feature", "left")  # a row a number
    number = F.col("feature").isin(*numeric)
    order = [F.when(number, F.col("segment").try_cast("int")), F.desc_nulls_last("mean"), F.col("segment")]
    return out.select(
        "feature", "segment", "pearson", "spearman", "mean", "median", "std", "count",
        F.row_number().over(Window.partitionBy("feature").orderBy(*order)).alias("rank"),
    )


def rank_edges(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Of every column the ``bins - 1`` values above which a value's bin goes up by
    one: its bin is floor(bins * rows with smaller values / rows), so a value that
    fills several bins has them to itself."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])

    def ranks(n):
        return [F.ceil(n * F.lit(k) / F.lit(bins)) - 1 for k in range(1, bins)]

    edges: dict[str, list] = {c: [] for c in cols}
    for r in order_statistics(df.select(F.inline(pairs)), "value", ranks, ["name"]).collect():
        edges[r["name"]].append(r["value"])
    return {c: sorted(e) for c, e in edges.items()}


def mutual_information(
    df: DataFrame, target: str, numeric: Sequence[str], text: Sequence[str], bins: int = 10
) -> DataFrame:
    """H6: ``(feature, mi)`` - binned plug-in MI in nats over the rows with a
    target.  Numbers: median fill, then bins by rank; text: categories with null
    as its own level; target: bins by rank.  The columns are written once, as
    medians, edges and joint counts each pass over them."""
    num = list(numeric)
    rows = df.where(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias(target), *[F.col(c).cast("double").alias(c) for c in num],
        *[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in text],
    )
    rows = measured(rows, "mutual-information")
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in num])
    med = {r["name"]: r["q"] for r in exact_quantiles(rows.select(F.inline(pairs)), "value", [0.5], ["name"]).collect()}
    filled = rows.fillna({c: m for c, m in med.items() if m is not None})
    edges = rank_edges(filled, num + [target], bins)
    ybin = bin_index(F.col(target), edges[target])
    items = [F.struct(F.lit(c).alias("feature"),
                      bin_index(F.col(c), edges[c]).cast("string").alias("x"))
             for c in num]
    items += [F.struct(F.lit(c).alias("feature"), F.col(c).alias("x")) for c in text]
    long = filled.select(ybin.alias("y"), F.inline(F.array(*items)))
    joint = long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("c"))
    # MI = H(X) + H(Y) - H(X,Y) with plug-in entropies
    #    = ln n - (S_x + S_y - S_xy) / n,  S = sum of c * ln c over the cells;
    # the three sums are aggregations of the joint table (no joins back)
    clogc = F.col("c") * F.log(F.col("c"))
    cells = joint.select("feature", F.lit("xy").alias("kind"), clogc.alias("s"), F.col("c").alias("n"))
    for kind, keys in (("x", ["feature", "x"]), ("y", ["feature", "y"])):
        marg = joint.groupBy(*keys).agg(F.sum("c").alias("c"))
        cells = cells.unionByName(
            marg.select("feature", F.lit(kind).alias("kind"), clogc.alias("s"), F.lit(0).cast("long").alias("n"))
        )
    per = cells.groupBy("feature").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("kind") == "xy", F.col("s"))).alias("sxy"),
        F.sum(F.when(F.col("kind") == "x", F.col("s"))).alias("sx"),
        F.sum(F.when(F.col("kind") == "y", F.col("s"))).alias("sy"),
    )
    n = F.col("n").cast("double")
    return per.select("feature", (F.log(n) - (F.col("sx") + F.col("sy") - F.col("sxy")) / n).alias("mi"))
