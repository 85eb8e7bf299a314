"""Profiles, group statistics, top-k and chart data (G*, J*, K*, V*).

Multi-column statistics unpivot the columns to ``(name, value)`` with one
``inline`` and aggregate by name: one scan for all columns, partial
aggregation before the shuffle.  Quantiles use the exact distributed primitive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions.exprs import bin_index, equal_width_edges, sample_kurt, sample_skew
from sifter.operators.ranks import exact_quantiles, measured, modes


def stack(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.inline(pairs))


def _quartiles(long: DataFrame, group: Sequence[str], probs=(0.25, 0.5, 0.75), approx=False) -> DataFrame:
    q = exact_quantiles(long, "value", list(probs), list(group), approx=approx)
    return q.groupBy(*group).agg(
        *[F.max(F.when(F.col("p_idx") == i, F.col("q"))).alias(f"_q{i}") for i in range(len(probs))]
    )


def describe(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """G1: count, mean, std (ddof 1), min, 25/50/75 % (linear), max per column."""
    long = stack(df, cols).where(F.col("value").isNotNull())
    base = long.groupBy("name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    qs = _quartiles(long, ["name"], approx=approx)
    return base.join(qs, "name", "left").select(
        "name", "count", "mean", "std", "min",
        F.col("_q0").alias("p25"), F.col("_q1").alias("p50"), F.col("_q2").alias("p75"), "max",
    )


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness and excess kurtosis per column."""
    long = stack(df, cols).where(F.col("value").isNotNull())
    agg = long.groupBy("name").agg(
        F.count("value").alias("n"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2")
    )
    return agg.select(
        "name", sample_skew(F.col("g1"), F.col("n")).alias("skew"), sample_kurt(F.col("g2"), F.col("n")).alias("kurt")
    )


def distribution_report(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """V6: G1 + G2 for every numeric column in one scan (+ one quantile pass)."""
    return describe(df, cols, approx=approx).join(moments(df, cols), "name")


def distribution_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """V6, numbers: ``name, bin, lo, hi, count`` of equal-width bins, every bin
    kept, in the order of name and bin.  One pass for the ranges, one for all counts."""
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)],
    ).first()
    edges = {c: equal_width_edges(row[f"lo{i}"], row[f"hi{i}"], bins) for i, c in enumerate(cols) if row[f"lo{i}"] is not None}
    cells = [F.struct(F.lit(c).alias("name"), bin_index(F.col(c).cast("double"), e[1:-1]).alias("bin")) for c, e in edges.items()]
    grid = [(c, k + 1, e[k], e[k + 1]) for c, e in edges.items() for k in range(bins)]
    grid = df.sparkSession.createDataFrame(grid, "name string, bin int, lo double, hi double")
    if not edges:
        return grid.withColumn("count", F.lit(0).cast("long"))
    counts = df.select(F.inline(F.array(*cells))).where(F.col("bin").isNotNull()).groupBy("name", "bin").agg(
        F.count(F.lit(1)).alias("count")
    )
    # a row for each column and bin
    out = F.broadcast(grid).join(counts, ["name", "bin"], "left")
    return out.withColumn("count", F.coalesce("count", F.lit(0)).cast("long")).orderBy("name", "bin")


def distribution_categories(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V6, text: ``name, value, count, percent`` of every column in one pass, the
    most frequent value of a column first (nulls excluded)."""
    cells = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols]
    counts = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull()).groupBy("name", "value").agg(
        F.count(F.lit(1)).alias("count")
    )
    counts = measured(counts, "category-counts")
    totals = counts.groupBy("name").agg(F.sum("count").alias("total"))  # a row a column
    out = counts.join(F.broadcast(totals), "name")
    out = out.select("name", "value", "count", (F.col("count") * 100.0 / F.col("total")).alias("percent"))
    return out.orderBy("name", F.desc("count"), "value")


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """``value, count, percent`` (nulls excluded), from one pass."""
    return distribution_categories(df, [c]).select(F.col("value").alias(c), "count", "percent")


def group_stats(
    df: DataFrame, group: str | Sequence[str], target: str, approx: bool = False, extra: dict | None = None
) -> DataFrame:
    """Mean, median, std, count of ``target`` per group (``extra``: more
    named aggregates computed in the same aggregation).  Rows with a null key
    belong to no group."""
    g = [group] if isinstance(group, str) else list(group)
    df = df.dropna(subset=g)
    more = [e.alias(name) for name, e in (extra or {}).items()]
    base = df.groupBy(*g).agg(
        F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"), F.count(target).alias("count"), *more
    )
    med = exact_quantiles(df.select(*g, target), target, [0.5], g, approx=approx).select(
        *g, F.col("q").alias("median")
    )
    return base.join(med, on=g, how="left").select(*g, "mean", "median", "std", "count", *(extra or {}))


def group_mean(df: DataFrame, group: str, target: str) -> DataFrame:
    """Groups by ascending mean; rows with a null key belong to no group."""
    means = df.dropna(subset=[group]).groupBy(group).agg(F.avg(target).alias("mean"))
    return means.orderBy("mean", group)


def group_modes(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per group, the mode of each column (ties -> smallest value)."""
    out = None
    for c in cols:
        m = modes(df, c, group).select(*group, F.col("mode").alias(c))
        out = m if out is None else out.join(m, on=list(group), how="full")
    return out


def argmax_label(df: DataFrame, label: str, value: str) -> DataFrame:
    """Label of the maximal value (ties -> smallest label)."""
    return df.agg(F.min_by(F.col(label), F.struct(-F.col(value), F.col(label))).alias(label))


def top_k(df: DataFrame, by: Column | str, k: int, tie: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """K1: sort by score with an explicit tie-break, first k (TakeOrderedAndProject)."""
    b = F.col(by) if isinstance(by, str) else by
    order = [b.asc() if ascending else b.desc()] + [F.col(t).asc() for t in tie]
    return df.orderBy(*order).limit(k)


def top_and_bottom(df: DataFrame, by: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """K2: top-k and bottom-k by ``by`` (union of two bounded top-k)."""
    top = top_k(df, by, k, tie).withColumn("end", F.lit("top"))
    bottom = top_k(df, by, k, tie, ascending=True).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


def box_stats(df: DataFrame, c: str, approx: bool = False, by: str | None = None) -> DataFrame:
    """V2: quartiles, 1.5 IQR fences, whiskers (extreme values inside the fences)
    and the number of values outside them; with ``by`` a row of them for each of
    its values (null is one) that has any. A column without values gives a row of nulls."""
    group = F.lit(1) if by is None else F.col(by)
    long = df.select(group.alias("_g"), F.col(c).cast("double").alias("value")).where(F.col("value").isNotNull())
    qs = measured(_quartiles(long, ["_g"], approx=approx), "box-quartiles").alias("q")
    iqr = F.col("_q2") - F.col("_q0")
    fences = qs.select(F.col("_g").alias("_k"), "_q0", "_q1", "_q2", (F.col("_q0") - 1.5 * iqr).alias("_lo"), (F.col("_q2") + 1.5 * iqr).alias("_hi"))
    v, lo, hi = F.col("value"), F.col("_lo"), F.col("_hi")
    inside = (v >= lo) & (v <= hi)
    rows = long.join(fences, F.col("_g").eqNullSafe(F.col("_k")))
    keys = [] if by is None else [F.col("_g").alias(by)]
    return rows.groupBy(*keys).agg(
        F.max("_q0").alias("q1"), F.max("_q1").alias("median"), F.max("_q2").alias("q3"),
        F.max(iqr).alias("iqr"), F.max(lo).alias("lower_fence"), F.max(hi).alias("upper_fence"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("n_outliers"),
    )


def fitted_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """V4: least-squares line ``y = slope * x + intercept``."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def replicate_digest(key: str, replicate: Column, seed: int) -> Column:
    """The md5 of "key:replicate:seed", so that a row's weight in a bootstrap replicate depends on
    nothing else and other engines draw alike."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(":"), replicate.cast("string"), F.lit(f":{seed}")))


def poisson_weight(digest: Column) -> Column:
    """The Poisson(1) weight of a digest, whose first 8 hex digits are a chance; digits compare as the
    numbers do. It is named POISSON times: let it be a column of its own, and do not filter by the
    weight, or Spark computes the digest in each place."""
    weight, below, term = F.lit(0), 0.0, math.exp(-1)
    for k in range(POISSON):  # beyond it the chance is under 1e-9
        below, term = below + term, term / (k + 1)
        weight = weight + (digest >= F.lit(f"{math.ceil(below * 2**32):08x}")).cast("int")
    return weight


POISSON = 12


def fitted_band(df: DataFrame, key: str, x: str, y: str, points: int = 20, replicates: int = 200, level: float = 0.95, seed: int = 42) -> DataFrame:
    """V4: the least-squares line on ``points`` values from the least to the largest x, with a
    bootstrap band: ``point, x, fit, low, high``.

    One scan. A row takes part in a replicate as often as its Poisson weight says; weights only enter
    sufficient statistics, which tasks add up by replicate, so nothing is resampled or moved but a row
    a task and replicate. The band is the percentiles of the replicates' lines. Rows without x or y do
    not count; without two different x there is no line and no row."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    known = df.where(a.isNotNull() & b.isNotNull()).select(F.col(key).alias("_key"), a.alias("_x"), b.alias("_y"))
    span = known.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi")).first()
    if span["lo"] is None or span["lo"] == span["hi"]:
        return df.sparkSession.createDataFrame([], "point int, x double, fit double, low double, high double")
    lo, step = span["lo"], (span["hi"] - span["lo"]) / (points - 1)
    r = F.col("r")
    w = F.when(r == 0, F.lit(1)).otherwise(poisson_weight(F.col("u"))).cast("double")  # replicate 0: the rows as they are
    # every row is drawn for many times, so that small files are work for many tasks
    rows = known.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    rows = rows.withColumn("u", replicate_digest("_key", r, seed)).withColumn("w", w)
    v = F.col("_x") - F.lit(lo)
    drawn = lambda term: F.sum(F.when(F.col("w") > 0, term))
    sums = rows.groupBy("r").agg(
        drawn(F.col("w")).alias("n"), drawn(F.col("w") * v).alias("sx"), drawn(F.col("w") * F.col("_y")).alias("sy"),
        drawn(F.col("w") * v * v).alias("sxx"), drawn(F.col("w") * v * F.col("_y")).alias("sxy"),
    )
    slope = F.try_divide(F.expr("n * sxy - sx * sy"), F.expr("n * sxx - sx * sx"))
    lines = measured(sums.withColumn("slope", slope).withColumn("base", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")), "band-lines")
    grid = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("point"), F.lit(i * step).alias("v")) for i in range(points)]))
    at = lines.where("slope IS NOT NULL").select("r", "slope", "base", grid.alias("g")).select(
        "r", "g.point", (F.col("g.v") + F.lit(lo)).alias("x"), (F.col("base") + F.col("slope") * F.col("g.v")).alias("value")
    )
    fit = at.where("r = 0").select("point", "x", F.col("value").alias("fit"))
    # points x replicates values: bounded by the parameters
    tails = [(1 - level) / 2, (1 + level) / 2]
    band = at.where("r > 0").groupBy("point").agg(F.expr(f"percentile(value, array({tails[0]!r}D, {tails[1]!r}D))").alias("q"))
    return fit.join(band, "point").select("point", "x", "fit", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def density_grid(df: DataFrame, c: str, points: int = 50) -> DataFrame:
    """V1: Gaussian KDE (Scott bandwidth ``std * n^(-1/5)``) on ``points`` grid
    values from min to max.  One scan: one ``sum`` per grid point inside a single
    aggregation (partial aggregation, no row x grid product).  Without values, or
    with one value alone, there is no density and no row."""
    stats = df.agg(
        F.count(c).alias("n"), F.stddev_samp(c).alias("sd"), F.min(c).alias("mn"), F.max(c).alias("mx")
    ).first()
    n, sd, mn, mx = stats["n"], stats["sd"], stats["mn"], stats["mx"]
    if not sd:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = sd * n ** (-0.2)
    step = (mx - mn) / (points - 1)
    grid = [mn + i * step for i in range(points)]
    x = F.col(c).cast("double")
    sums = df.where(x.isNotNull()).agg(
        *[F.sum(F.exp(-0.5 * F.pow((F.lit(g) - x) / F.lit(h), 2))).alias(f"k{i}") for i, g in enumerate(grid)]
    )
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    pairs = F.array(
        *[F.struct(F.lit(i + 1).alias("point"), F.lit(g).alias("x"), (F.col(f"k{i}") * F.lit(norm)).alias("density"))
          for i, g in enumerate(grid)]
    )
    return sums.select(F.inline(pairs))


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """G11 on the log scale and the original scale (``expm1``)."""
    r = F.col(y) - F.col(pred)
    ro = F.expm1(F.col(y)) - F.expm1(F.col(pred))
    return df.agg(
        F.avg(r * r).alias("mse_log"),
        F.sqrt(F.avg(r * r)).alias("rmse_log"),
        F.avg(F.abs(r)).alias("mae_log"),
        (1 - F.try_divide(F.sum(r * r), F.count(y) * F.var_pop(y))).alias("r2_log"),
        F.sqrt(F.avg(ro * ro)).alias("rmse_orig"),
        F.avg(F.abs(ro)).alias("mae_orig"),
    )


def fold_summary(per_fold: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean and population std (numpy ddof 0) of per-fold metrics."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return per_fold.agg(*aggs)


def error_by_segment(df: DataFrame, y_log: str, pred_log: str, segment: str, approx: bool = False) -> DataFrame:
    """Per segment mean/median/max abs log error, count, MAE in original scale."""
    e = df.select(
        segment,
        F.abs(F.col(y_log) - F.col(pred_log)).alias("_err"),
        F.abs(F.expm1(F.col(y_log)) - F.expm1(F.col(pred_log))).alias("_err_orig"),
        F.col(y_log).alias("_y"),
    )
    base = e.groupBy(segment).agg(
        F.avg("_err").alias("mean_log_err"),
        F.max("_err").alias("max_log_err"),
        F.count("_y").alias("n"),
        F.avg("_err_orig").alias("mae_original"),
    )
    med = exact_quantiles(e, "_err", [0.5], [segment], approx=approx).select(
        segment, F.col("q").alias("median_log_err")
    )
    return base.join(med, segment, "left").select(
        segment, "mean_log_err", "median_log_err", "max_log_err", "n", "mae_original"
    )
