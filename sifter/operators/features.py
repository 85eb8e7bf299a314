"""Feature columns (D1-D19) and categorical encodings.

Every feature is a column expression; a block of them is one ``select`` and
stays in whole-stage codegen.  Encoders fit tiny statistics (levels, means)
and apply them as literals or as a joined code table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions.exprs import col, flag, sum_cols
from sifter.operators.joins import literal_map
from sifter.operators.ranks import dense_codes, measured

# ---- D: arithmetic features --------------------------------------------------


def total(*cols: str | Column) -> Column:
    """Null-propagating sum."""
    return sum_cols(cols)


def product(a: str | Column, b: str | Column) -> Column:
    """D2."""
    return col(a) * col(b)


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """D3: e.g. full baths + 0.5 * half baths."""
    return sum_cols([col(c) * F.lit(w) if w != 1 else col(c) for c, w in weights.items()])


def age(df: DataFrame, year_col: str, ref_col: str, default_ref: int = 2010) -> Column:
    """Reference year (a column if present, else a constant) minus a year."""
    ref = F.col(ref_col) if ref_col in df.columns else F.lit(default_ref)
    return ref - F.col(year_col)


def equal_flag(a: str | Column, b: str | Column) -> Column:
    """``(a == b)`` as 0/1 (null -> 0)."""
    return flag(col(a) == col(b))


def positive_flag(c: str | Column) -> Column:
    """``(c > 0)`` as 0/1 (null -> 0)."""
    return flag(col(c) > 0)


def member_flag(*pairs: tuple[str, Sequence]) -> Column:
    """Any ``column in values`` as 0/1."""
    cond = None
    for c, values in pairs:
        e = F.col(c).isin(*values)
        cond = e if cond is None else cond | e
    return flag(cond)


def decade(c: str | Column, width: int = 10) -> Column:
    """D14 after D13: ``floor(try_cast(y as double) / width) * width``."""
    y = F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")
    return (F.floor(y / width) * width).cast("long")


def try_number(c: str) -> Column:
    """Tolerant numeric parse (``pd.to_numeric(errors='coerce')``)."""
    return F.col(c).try_cast("double")


def clamp_non_negative(c: str | Column) -> Column:
    """D12."""
    return F.greatest(col(c), F.lit(0.0))


# ---- E: encodings ---------------------------------------------------------------


def ordinal_encode(df: DataFrame, maps: Mapping[str, Mapping[str, int]], unmapped=0) -> DataFrame:
    """Literal map per column; unmapped (and null) -> ``unmapped``
    (``None`` keeps them null, as the notebooks do)."""
    out = []
    for c in df.columns:
        if c in maps:
            e = literal_map(maps[c])[F.col(c)]
            if unmapped is not None:
                e = F.coalesce(e, F.lit(unmapped))
            out.append(e.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def factorize(df: DataFrame, cols: Sequence[str], suffix: str = "", order_col: str | None = None) -> DataFrame:
    """Integer codes, null -> -1, from a distributed dense rank joined back on
    the value: of the values themselves, or, with ``order_col`` (a row's place in
    its file, ``files.with_row_index``), of the first place of each: pandas'
    codes by first appearance."""
    out = df
    for c in cols:
        if order_col is None:
            codes = dense_codes(df, c, "_code")
        else:
            first = measured(df.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(order_col).alias("_first")), "first-places")
            codes = first.join(dense_codes(first, "_first", "_code"), "_first").drop("_first")
        out = (
            out.join(measured(codes, "codes"), on=c, how="left")
            .withColumn(c + suffix, F.coalesce(F.col("_code"), F.lit(-1)).cast("long"))
            .drop("_code")
        )
    return out


def one_hot_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct levels per column (one job for all columns); each becomes
    a column, so the caller chooses columns with few."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols])
    lv = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in lv.collect():
        levels[r["name"]].append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot_drop_first(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``get_dummies(drop_first=True)``: the alphabetically first level is
    dropped, null -> all zeros.  (``OneHotEncoder.dropLast`` drops the last.)"""
    levels = one_hot_levels(df, cols)
    keep = [F.col(c) for c in df.columns if c not in cols]
    dummies, taken = [], {c for c in df.columns if c not in cols}
    for c in cols:
        for lv in levels[c][1:]:
            # pandas names the column "<col>_<level>"; a "." (e.g. level "2.5Fin")
            # would read as struct access in Spark references, so it becomes "_"
            name = f"{c}_{lv}".replace(".", "_")
            while name in taken:  # "a.b" and "a_b" stay two columns
                name += "_"
            taken.add(name)
            dummies.append(flag(F.col(c).cast("string") == F.lit(lv)).alias(name))
    return df.select(*keep, *dummies)


def standardize(df: DataFrame, cols: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """E5: ``(x - mean) / population std``; zero variance -> 0 (scikit-learn's
    StandardScaler).  Spark ML's StandardScaler uses the sample std."""
    src = df.fillna(fill, subset=list(cols)) if fill is not None else df
    st = src.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    out = []
    for c in src.columns:
        if c in cols:
            i = cols.index(c)
            m, s = st[f"m{i}"], st[f"s{i}"]
            scale = s if s else 1.0
            out.append(((F.col(c) - F.lit(m)) / F.lit(scale)).alias(c))
        else:
            out.append(F.col(c))
    return src.select(*out)


class CategoryCodes:
    """Alphabetical codes of the training rows' levels; unseen values and nulls get the number of
    levels. The levels are a written table, ranked and joined by Spark: the driver holds their count."""

    def __init__(self, train: DataFrame, cols: Sequence[str]):
        self.tables = {c: measured(dense_codes(train, c, "_code"), "levels") for c in cols}
        self.sizes = {c: t.count() for c, t in self.tables.items()}

    def transform(self, df: DataFrame, suffix: str = "_code") -> DataFrame:
        out = df
        for c, table in self.tables.items():
            code = F.coalesce(F.col("_code"), F.lit(self.sizes[c])).cast("double")
            out = out.join(table, c, "left").withColumn(c + suffix, code).drop("_code")
        return out.select(*df.columns, *[c + suffix for c in self.tables])
