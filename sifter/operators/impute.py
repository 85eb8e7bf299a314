"""Missing-value operators.

Fit statistics are tiny (one value per column or per group) and computed in a
single pass over all columns: columns are unpivoted to ``(name, value)`` and
aggregated by name, never one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.functions.exprs import NA_TEXT
from sifter.operators.columns import numeric_columns, present, text_columns
from sifter.operators.ranks import exact_quantiles, group_median, measured, modes


def fill_text(df: DataFrame, cols: Sequence[str], value: str = NA_TEXT) -> DataFrame:
    """Constant text fill (C1, C8, C9); absent columns are skipped."""
    cols = present(df, cols)
    return df.fillna(value, subset=cols) if cols else df


def fill_number(df: DataFrame, cols: Sequence[str], value: float = 0) -> DataFrame:
    """Constant numeric fill."""
    cols = present(df, cols)
    return df.fillna(value, subset=cols) if cols else df


def conditional_fill(
    df: DataFrame, target: str, flag_col: str, absent_value: str, fallback_col: str, absent_fill: float = 0
) -> DataFrame:
    """Where ``flag_col == absent_value`` fill ``target`` with ``absent_fill``,
    elsewhere with ``fallback_col``."""
    if target not in df.columns or flag_col not in df.columns:
        return df
    t = F.col(target)
    absent = F.coalesce(F.col(flag_col) == absent_value, F.lit(False))
    filled = F.when(absent, F.coalesce(t, F.lit(absent_fill).cast(df.schema[target].dataType))).otherwise(
        F.coalesce(t, F.col(fallback_col).cast(df.schema[target].dataType))
    )
    return df.withColumn(target, filled)


def group_median_fill(
    df: DataFrame, value_col: str, group_cols: Sequence[str], approx: bool = False
) -> DataFrame:
    """Fill with the group median.  Null-key rows and all-null groups
    stay null.  Medians come from the distributed exact quantile primitive and
    are joined back on the group key (no window over a hot group)."""
    if value_col not in df.columns or not all(g in df.columns for g in group_cols):
        return df
    med = group_median(df, value_col, group_cols, approx=approx).withColumnRenamed("median", "_grp_median")
    med = measured(med, "group-medians")
    out = df.join(med, on=list(group_cols), how="left")
    typ = df.schema[value_col].dataType
    filled = F.coalesce(F.col(value_col).cast("double"), F.col("_grp_median"))
    if not isinstance(typ, (T.DoubleType, T.FloatType)):
        filled = filled.cast("double")
    return out.withColumn(value_col, filled).drop("_grp_median").select(*df.columns)


def _stack(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast(cast).alias("value")) for c in cols])
    return df.select(F.inline(pairs))


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Mode (lowest value among ties) of several text columns in one job."""
    cols = present(df, cols)
    if not cols:
        return {}
    rows = modes(_stack(df, cols, "string"), "value", ["name"]).collect()
    return {r["name"]: r["mode"] for r in rows}


def column_medians(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict:
    """Exact median of several numeric columns in one pass."""
    cols = present(df, cols)
    if not cols:
        return {}
    rows = exact_quantiles(_stack(df, cols, "double"), "value", [0.5], ["name"], approx=approx).collect()
    return {r["name"]: r["q"] for r in rows}


def mode_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill text columns with their mode (ties -> smallest)."""
    m = column_modes(df, cols)
    return df.fillna({c: v for c, v in m.items() if v is not None}) if m else df


def median_fill(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Fill numeric columns with their median (integer columns become double,
    as a pandas integer column holding NaN already is float)."""
    med = column_medians(df, cols, approx=approx)
    out = df
    for c, v in med.items():
        if v is None:
            continue
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(float(v))))
    return out


def null_counts(df: DataFrame) -> DataFrame:
    """Null count of every column in one aggregation, as a one-row table."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])


def columns_with_nulls(df: DataFrame) -> list[str]:
    row = null_counts(df).first()
    return [c for c in df.columns if row[c]]


def global_fallback(df: DataFrame, approx: bool = False) -> DataFrame:
    """Numeric -> median, text -> mode, a text column with no value -> 'NA'."""
    nulls = columns_with_nulls(df)
    nums = [c for c in numeric_columns(df) if c in nulls]
    txts = [c for c in text_columns(df) if c in nulls]
    out = median_fill(df, nums, approx=approx)
    m = column_modes(df, txts)
    fills = {c: (m.get(c) if m.get(c) is not None else NA_TEXT) for c in txts}
    return out.fillna(fills) if fills else out


def missing_profile(df: DataFrame) -> DataFrame:
    """``(column, total, percent)`` for columns with nulls, most first."""
    n = F.count(F.lit(1))
    agg = df.agg(n.alias("_rows"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("total")) for c in df.columns])
    long = agg.select("_rows", F.inline(pairs))
    return long.where(F.col("total") > 0).select(
        "column", "total", (F.col("total") * 100.0 / F.col("_rows")).alias("percent")
    )


def null_total(df: DataFrame) -> DataFrame:
    """C11: total remaining nulls as a one-row table."""
    parts = [F.sum(F.col(c).isNull().cast("long")) for c in df.columns]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return df.agg(F.coalesce(total, F.lit(0)).cast("long").alias("null_total"))


def null_totals_before_after(df: DataFrame, cleaned: dict) -> DataFrame:
    """C11 audit of a cleaning step given as ``{column: cleaned expression}``:
    remaining nulls before and after it, in one aggregation over one scan."""
    before = [F.col(c).isNull().cast("long") for c in df.columns]
    after = [cleaned.get(c, F.col(c)).isNull().cast("long") for c in df.columns]

    def total(parts):
        acc = parts[0]
        for p in parts[1:]:
            acc = acc + p
        return F.coalesce(F.sum(acc), F.lit(0)).cast("long")

    return df.agg(total(before).alias("nulls_before"), total(after).alias("nulls_after"))
