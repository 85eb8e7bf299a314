"""Discretization (F1-F8) with pandas ``cut``/``qcut`` semantics.

Bin rule everywhere: right-closed, lowest value included, i.e. bin number =
``1 + #(interior edges < x)``.  Edges are fit statistics: (#columns x #bins)
doubles computed in one distributed pass (quantiles from the exact prefix-sum
primitive, min/max from one aggregation), then applied as literals in one
projection that stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions.exprs import (
    TIER_LABEL,
    bin_index,
    bin_labels,
    equal_width_edges,
    label_of,
)
from sifter.operators.columns import numeric_columns
from sifter.operators.ranks import exact_quantiles, measured, quantile_array


def quantile_probs(q: int) -> list[float]:
    return [i / q for i in range(q + 1)]


def _stack(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(F.inline(pairs))


def quantile_edges(df: DataFrame, cols: Sequence[str], q: int, approx: bool = False) -> dict[str, list[float]]:
    """``{column: [q+1 edges]}`` for several columns in one pass."""
    if not cols:
        return {}
    rows = exact_quantiles(_stack(df, cols), "value", quantile_probs(q), ["name"], approx=approx).collect()
    edges: dict[str, list] = {c: [None] * (q + 1) for c in cols}
    for r in rows:
        edges[r["name"]][r["p_idx"]] = r["q"]
    return edges


def min_max(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    if not cols:
        return {}
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"mn{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(c).cast("double")).alias(f"mx{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"mn{i}"], row[f"mx{i}"]) for i, c in enumerate(cols)}


def has_duplicates(edges: Sequence[float]) -> bool:
    return len(set(edges)) < len(edges)


class BinPlan:
    """Fitted edges per column; ``transform`` is one literal projection."""

    def __init__(self, edges: dict[str, list[float]], labels: dict[str, list[str]] | None, rename: dict | None = None):
        self.edges = edges
        self.labels = labels
        self.rename = rename or {}

    def index_expr(self, c: str):
        return bin_index(F.col(c).cast("double"), self.edges[c][1:-1])

    def expr(self, c: str):
        idx = self.index_expr(c)
        if self.labels is None:
            return idx
        return label_of(idx, self.labels[c])

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            out.append(self.expr(c).alias(c) if c in self.edges and c not in self.rename else F.col(c))
        for src, dst in self.rename.items():
            out.append(self.expr(src).alias(dst))
        return df.select(*out)


def fit_discretize(
    df: DataFrame, target: str = "price", bins: int = 5, id_col: str = "sale_id",
    cols: Sequence[str] | None = None, approx: bool = False,
) -> BinPlan:
    """Quantile bins with labels; target -> ``{target}Bin`` (an error if
    its edges repeat, like pandas); other numeric columns fall back to equal
    width when their quantile edges repeat."""
    labels = bin_labels(bins)
    if cols is None:
        cols = numeric_columns(df, exclude=[target, id_col])
    has_target = target in df.columns
    qcols = ([target] if has_target else []) + list(cols)
    qe = quantile_edges(df, qcols, bins, approx=approx)
    edges, lab = {}, {}
    fallback = [c for c in cols if qe[c][0] is None or has_duplicates(qe[c])]
    mm = min_max(df, fallback)
    for c in cols:
        if c in fallback:
            mn, mx = mm[c]
            if mn is None:
                continue
            edges[c] = equal_width_edges(mn, mx, bins)
        else:
            edges[c] = qe[c]
        lab[c] = labels
    rename = {}
    if has_target:
        if has_duplicates(qe[target]):
            raise ValueError(f"Bin edges of {target} must be unique: {qe[target]}")
        edges[target] = qe[target]
        lab[target] = labels
        rename[target] = f"{target}Bin"
    return BinPlan(edges, lab, rename)


def discretize(df: DataFrame, target: str = "price", bins: int = 5, id_col: str = "sale_id",
               cols: Sequence[str] | None = None) -> DataFrame:
    return fit_discretize(df, target, bins, id_col, cols).transform(df)


def cut_equal_width(df: DataFrame, c: str, bins: int, labels: Sequence[str] | None = None, out_col: str | None = None) -> DataFrame:
    """``pd.cut(x, bins, include_lowest=True)``; null where there is no value, and throughout a
    column without values."""
    mn, mx = min_max(df, [c])[c]
    if mn is None:
        return df.withColumn(out_col or c, F.lit(None).cast("string" if labels else "int"))
    edges = equal_width_edges(mn, mx, bins)
    idx = bin_index(F.col(c).cast("double"), edges[1:-1])
    return df.withColumn(out_col or c, label_of(idx, labels) if labels else idx)


def histogram(df: DataFrame, c: str, bins: int = 10) -> DataFrame:
    """equal-width histogram (pandas ``cut`` edges), every bin kept; a column without values
    has no bins."""
    mn, mx = min_max(df, [c])[c]
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, count long")
    edges = equal_width_edges(mn, mx, bins)
    idx = bin_index(F.col(c).cast("double"), edges[1:-1])
    counts = df.select(idx.alias("bin")).where(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("count")
    )
    spark = df.sparkSession
    grid = spark.createDataFrame(
        [(i + 1, float(edges[i]), float(edges[i + 1])) for i in range(bins)], "bin int, lo double, hi double"
    )
    # ``grid`` has exactly ``bins`` rows: a structural bound.
    return F.broadcast(grid).join(counts, "bin", "left").select(
        "bin", "lo", "hi", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")
    )


def merged_quantile_edges(df: DataFrame, c: str, q: int, approx: bool = False) -> list[float]:
    e = quantile_edges(df, [c], q, approx=approx)[c]
    return sorted(set(e))


def qcut_merged(df: DataFrame, c: str, q: int, out_col: str | None = None) -> DataFrame:
    """quantile bins with duplicate edges merged; adds ``_lo``/``_hi`` bounds."""
    edges = merged_quantile_edges(df, c, q)
    idx = bin_index(F.col(c).cast("double"), edges[1:-1])
    arr_lo = F.array(*[F.lit(float(e)) for e in edges[:-1]])
    arr_hi = F.array(*[F.lit(float(e)) for e in edges[1:]])
    o = out_col or f"{c}_bin"
    o_idx = F.col(o)
    return (
        df.withColumn(o, idx)
        .withColumn(f"{o}_lo", F.when(o_idx.isNotNull(), F.element_at(arr_lo, o_idx)))
        .withColumn(f"{o}_hi", F.when(o_idx.isNotNull(), F.element_at(arr_hi, o_idx)))
    )


def qcut_codes(df: DataFrame, c: str, q: int, out_col: str | None = None) -> DataFrame:
    """0-based integer quantile codes, duplicate edges merged."""
    edges = merged_quantile_edges(df, c, q)
    return df.withColumn(out_col or f"{c}_code", bin_index(F.col(c).cast("double"), edges[1:-1]) - 1)


def decile_labels(df: DataFrame, c: str, out_col: str = "decile") -> DataFrame:
    """``D1..D10``; repeated edges are an error (pandas raises)."""
    edges = quantile_edges(df, [c], 10)[c]
    if has_duplicates(edges):
        raise ValueError(f"Bin edges of {c} must be unique")
    labels = [f"D{i}" for i in range(1, 11)]
    return df.withColumn(out_col, label_of(bin_index(F.col(c).cast("double"), edges[1:-1]), labels))


class GroupTiers:
    """F8: group -> price tier.  ``mapping`` stays a DataFrame (one row per
    group, joined, never collected); unseen groups get the middle tier."""

    def __init__(self, mapping: DataFrame, group_col: str, bins: int, out_col: str = "NbPriceTier"):
        self.mapping = mapping
        self.group_col = group_col
        self.bins = bins
        self.out_col = out_col

    @property
    def default(self) -> str:
        return TIER_LABEL.format(i=self.bins // 2 + 1)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.join(self.mapping, on=self.group_col, how="left")
        return out.withColumn(self.out_col, F.coalesce(F.col(self.out_col), F.lit(self.default)))


def fit_group_tiers(
    df: DataFrame, group_col: str, target: str, bins: int = 5, out_col: str = "NbPriceTier"
) -> GroupTiers:
    means = df.groupBy(group_col).agg(F.avg(target).alias("_mean")).where(F.col(group_col).isNotNull())
    means = measured(means, "group-means")
    edges = quantile_edges(means, ["_mean"], bins)["_mean"]
    if has_duplicates(edges):
        raise ValueError("Bin edges of the group means must be unique")
    labels = [TIER_LABEL.format(i=i) for i in range(1, bins + 1)]
    mapping = means.select(group_col, label_of(bin_index("_mean", edges[1:-1]), labels).alias(out_col))
    mapping = measured(mapping, "group-tiers")
    return GroupTiers(mapping, group_col, bins, out_col)


def fold_group_tiers(
    df: DataFrame, group_col: str, target: str, fold: Column, folds: int, bins: int = 5, out_col: str = "NbPriceTier"
) -> DataFrame:
    """F8 inside a cross-validation: every row's tier from the rows of the other folds alone.

    One aggregation gives sums by (group, fold); a group's mean outside a fold is its total less that
    fold's part, so no fold rescans the rows. The edges of all folds are fitted in one pass over these
    means. Groups, or targets, not known outside the fold get the middle tier; repeated edges are an
    error, as in ``fit_group_tiers``."""
    rows = df.withColumn("_fold", fold)
    cells = rows.where(F.col(group_col).isNotNull()).groupBy(group_col, "_fold").agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    cells = measured(cells, "fold-cells")
    total = cells.groupBy(group_col).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    every = total.withColumn("_fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    outside = every.join(cells, [group_col, "_fold"], "left").fillna(0, ["_n"])
    mean = F.try_divide(F.col("_ts") - F.coalesce("_s", F.lit(0.0)), F.col("_tn") - F.col("_n"))
    means = measured(outside.select(group_col, "_fold", mean.alias("_mean")).where("_mean IS NOT NULL"), "fold-means")
    edges = quantile_array(means, "_mean", quantile_probs(bins), ["_fold"])
    edges = measured(edges, "fold-edges")  # a row a fold
    if not edges.where(F.size(F.array_distinct("qs")) < bins + 1).isEmpty():
        raise ValueError("Bin edges of the group means must be unique in every fold")
    labels = F.array(*[F.lit(TIER_LABEL.format(i=i)) for i in range(1, bins + 1)])
    inner = F.slice("qs", 2, bins - 1)
    place = 1 + F.size(F.filter(inner, lambda e: e < F.col("_mean")))
    tiers = measured(means.join(edges, "_fold").select(group_col, "_fold", F.element_at(labels, place).alias(out_col)), "fold-tiers")
    middle = F.lit(TIER_LABEL.format(i=bins // 2 + 1))
    out = rows.join(tiers, [group_col, "_fold"], "left")
    return out.withColumn(out_col, F.coalesce(out_col, middle)).select(*df.columns, out_col)
