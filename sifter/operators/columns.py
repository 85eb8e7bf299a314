"""Projection and schema shaping (B1-B6, B10, B13).  All are plan-level
``select``/``drop`` on the schema: Catalyst prunes the scans accordingly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Wanted columns that exist, in order, without duplicates."""
    have = set(df.columns)
    return [c for c in dict.fromkeys(cols) if c in have]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of a numeric type."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in ex]


def column_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Contiguous slice of columns by names, inclusive (B1)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return df.select(*cols[i : j + 1])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns, ignoring absent ones (B2)."""
    return df.drop(*cols)


def align_columns(df: DataFrame, columns: Sequence[str], category_cols: Sequence[str] = ()) -> DataFrame:
    """``reindex(columns=...)`` then zero-fill non-category columns.

    Missing columns appear as nulls (then 0.0, as pandas adds a float NaN
    column); extra columns are dropped; category columns keep their nulls.
    """
    have = set(df.columns)
    cats = set(category_cols)
    out = []
    for c in columns:
        if c in have:
            e = F.col(c)
            if c not in cats and isinstance(df.schema[c].dataType, NUMERIC_TYPES):
                e = F.coalesce(e, F.lit(0).cast(df.schema[c].dataType))
            out.append(e.alias(c))
        elif c in cats:
            out.append(F.lit(None).cast("string").alias(c))
        else:
            out.append(F.lit(0.0).alias(c))
    return df.select(*out)


def dropna_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.dropna(subset=list(cols))
