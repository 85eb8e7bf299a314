"""Implicit joins of the reference (I1-I4) and set operations.

Broadcast policy: a side is broadcast explicitly only when its size has a
structural bound (a literal map, a per-partition table).  Fitted tables (group
statistics, codes) are written first (``ranks.measured``): Spark then plans with
their true size, broadcasts a small one without moving the other side, and
joins a large one by shuffle with skew splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions.exprs import col


def literal_map(mapping: Mapping) -> Column:
    """A map literal (bounded by the size of the Python dict)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def lookup(df: DataFrame, key: str, mapping: Mapping, out_col: str, default=None) -> DataFrame:
    """``Series.map(dict)`` (I1) with an optional default for unmatched keys."""
    value = literal_map(mapping)[col(key)]
    if default is not None:
        value = F.coalesce(value, F.lit(default))
    return df.withColumn(out_col, value)


def append_by_key(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Index-aligned column append (I3) as an inner equi-join on the row key."""
    return df.join(other, on=key, how="inner")


def remove_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Remove rows by key set (I4): ``left_anti``."""
    return df.join(keys.select(key), on=key, how="left_anti")


def union_keys(*key_sets: DataFrame) -> DataFrame:
    """Distinct union of key sets."""
    out = key_sets[0]
    for k in key_sets[1:]:
        out = out.unionByName(k)
    return out.distinct()


def concat_tagged(parts: Mapping[str, DataFrame], tag_col: str = "split") -> DataFrame:
    """Vertical concat keeping duplicates (S2), carrying a tag column so the
    parts can be split again by value (B14) instead of by row position."""
    out = None
    for tag, part in parts.items():
        p = part.withColumn(tag_col, F.lit(tag))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def split_tagged(df: DataFrame, tag: str, tag_col: str = "split") -> DataFrame:
    return df.where(F.col(tag_col) == tag).drop(tag_col)
