"""Shared pieces of the bound queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.session import scratch_path
from sifter.sources.tables import SALE_COLUMNS, sale, with_sale  # noqa: F401


def own(df: DataFrame, tag: str = "own") -> DataFrame:
    """``df`` written to the shared scratch folder and read back, for a query that passes over a
    derived table several times: select the query's own columns first."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


DIGITS = 6


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (the oracle rounds the same columns)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def R(expr: str, alias: str, digits: int = DIGITS) -> str:
    """Rounded double expression for oracle SQL.  A tiny negative rounds to
    -0.0 in DuckDB but to 0.0 in Spark (decimal rounding): zero is normalized."""
    r = f"round(cast({expr} as double), {digits})"
    return f"(case when {r} = 0 then cast(0 as double) else {r} end) as {alias}"


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def sql_bin(v: str, edges: str) -> str:
    """Right-closed 1-based bin of ``v`` over a DuckDB list of edges (null -> null)."""
    return (f"(case when {v} is null then null else "
            f"1 + len(list_filter(list_slice({edges}, 2, len({edges}) - 1), lambda x: x < {v})) end)")


def probs_sql(q: int) -> str:
    return "[" + ", ".join(repr(i / q) for i in range(q + 1)) + "]"


def sql_equal_width(mn: str, mx: str, bins: int) -> str:
    """pandas ``cut`` edges as a DuckDB list (lowest edge widened by 0.1 %)."""
    return (
        f"(case when {mn} = {mx} then list_transform(range(0, {bins + 1}), lambda i: "
        f"case when i = {bins} then {mx} + (case when {mx} <> 0 then 0.001 * abs({mx}) else 0.001 end) "
        f"else i * ((({mx} + (case when {mx} <> 0 then 0.001 * abs({mx}) else 0.001 end)) - "
        f"({mn} - (case when {mn} <> 0 then 0.001 * abs({mn}) else 0.001 end))) / {bins}) + "
        f"({mn} - (case when {mn} <> 0 then 0.001 * abs({mn}) else 0.001 end)) end) "
        f"else list_transform(range(0, {bins + 1}), lambda i: "
        f"case when i = 0 then {mn} - ({mx} - {mn}) * 0.001 when i = {bins} then {mx} "
        f"else i * (({mx} - {mn}) / {bins}) + {mn} end) end)"
    )


def sql_labels(labels) -> str:
    return "[" + sql_list(labels) + "]"
