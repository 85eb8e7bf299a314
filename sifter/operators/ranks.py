"""Exact order statistics without single-task windows.

Spark's exact ``percentile``/``median``/``mode`` aggregates keep a value->count
map per group and merge it in one task, and a ``Window`` without
``partitionBy`` moves all rows to one task.  Both break when one group holds a
third of the data.  The primitives here stay exact and distributed, on one path
at every size.

Order statistics (quantiles, medians) are narrowed by counting.  A pass counts
the rows in ``BRACKETS`` equal parts of the interval that holds a wanted rank,
by partial aggregation, and goes on with the smallest and largest value of the
part that holds it.  Each pass divides the rows left by up to ``BRACKETS``; no
row moves, and only the tiny table of intervals is written.

Ranks of every value (average ranks, dense codes) need all of them:

1. ``groupBy(group, value).count()`` - partial aggregation, and the shuffle key
   includes the value, so a hot group is spread over many tasks;
2. ``repartitionByRange(group, value)`` + ``sortWithinPartitions`` - a hot
   group spans several range partitions;
3. a running sum inside each partition (``mapInPandas``, Arrow batches);
4. per-(partition, group) totals -> offsets.  That table has at most
   (#partitions + #groups) rows; its window is partitioned by group and each
   group holds at most #partitions rows;
5. offsets joined back -> ``n_before`` = rows of the group with a smaller value.

The per-partition table is written to the shared scratch folder before it is
used twice, so partition ids stay consistent and lineage is cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.session import scratch_path


def _local_prefix(group_cols: list[str]):
    """Running sum of ``_n`` per group inside one sorted partition."""

    def run(batches):
        prev_key, carry = None, 0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            if group_cols:
                key = pdf[group_cols[0]].astype(str)
                for c in group_cols[1:]:
                    key = key + "\x1f" + pdf[c].astype(str)
            else:
                key = pd.Series(np.zeros(len(pdf), dtype=np.int8), index=pdf.index).astype(str)
            change = key.ne(key.shift())
            continues = prev_key is not None and key.iloc[0] == prev_key
            change.iloc[0] = not continues
            seg = change.cumsum()
            n = pdf["_n"].astype("int64")
            before = n.groupby(seg).cumsum() - n
            if continues:
                before = before.where(seg != seg.iloc[0], before + carry)
            carry = int(before.iloc[-1] + n.iloc[-1])
            prev_key = key.iloc[-1]
            pdf["_local_before"] = before.astype("int64")
            yield pdf

    return run


# Parts a pass divides an interval into.
BRACKETS = 1 << 14


def measured(df: DataFrame, tag: str, **options) -> DataFrame:
    """A fitted table written to the shared scratch folder and read back.  Spark
    then knows its size when it plans a join: a small one is broadcast without
    shuffling the other side, a large one is joined by shuffle with skew splits.
    ``options`` go to the writer."""
    path = scratch_path(df.sparkSession, tag)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: str, right: str, cols: Sequence[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def order_statistics(
    df: DataFrame, value_col: str, ranks: Callable[[Column], list[Column]], group_cols: Sequence[str] = ()
) -> DataFrame:
    """``group..., n, idx, value``: of every group the values at 0-based ranks in
    ascending order, nulls and NaN left out.  ``ranks`` maps the group's row
    count ``n`` to its ranks; idx counts them."""
    g = [f"__g{i}" for i in range(len(group_cols))] or ["__g0"]
    keys = [F.col(c).alias(a) for a, c in zip(g, group_cols)] or [F.lit(0).alias("__g0")]
    rows = df.select(*keys, F.col(value_col).cast("double").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & ~F.isnan("v"))
    stats = rows.groupBy(*g).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = [F.struct(F.lit(i).alias("idx"), r.cast("long").alias("rank")) for i, r in enumerate(ranks(F.col("n")))]
    targets = stats.select(*g, "n", "lo", "hi", F.lit(0).cast("long").alias("base"), F.inline(F.array(*wanted)))
    targets = measured(targets, "ranks")
    columns = [*g, "n", "idx", "rank", "lo", "hi", "base"]
    while not targets.where("lo < hi").isEmpty():
        pending = targets.where("lo < hi")
        spans = pending.select(*g, "lo", "hi", "base").distinct()
        inside = rows.alias("r").join(spans.alias("s"), _same("r", "s", g) & F.expr("r.v between s.lo and s.hi"))
        # halves, as hi - lo may exceed the largest double
        part = F.try_divide(F.expr("r.v / 2 - s.lo / 2"), F.expr("s.hi / 2 - s.lo / 2"))
        tiny = F.when(F.expr("r.v = s.lo"), 0.0).otherwise(1.0 / BRACKETS)  # hi - lo too small to divide by
        part = F.least(F.floor(F.coalesce(part, tiny) * BRACKETS), F.lit(BRACKETS - 1))
        cells = inside.select("s.*", "r.v", F.when(F.expr("r.v = s.hi"), BRACKETS).otherwise(part).alias("part"))
        cells = cells.groupBy(*g, "lo", "hi", "base", "part").agg(
            F.count("v").alias("c"), F.min("v").alias("a"), F.max("v").alias("b")
        )
        # at most BRACKETS + 1 rows an interval
        upto = F.sum("c").over(Window.partitionBy(*g, "lo", "hi").orderBy("part")) + F.col("base")
        cells = cells.withColumn("upto", upto)
        holds = _same("p", "c", [*g, "lo", "hi"]) & F.expr("p.rank < c.upto and p.rank >= c.upto - c.c")
        found = pending.alias("p").join(cells.alias("c"), holds).select(
            *(f"p.{x}" for x in g), "p.n", "p.idx", "p.rank", F.col("c.a").alias("lo"), F.col("c.b").alias("hi"),
            F.expr("c.upto - c.c").alias("base"),
        )
        targets = measured(targets.where("lo = hi").select(*columns).unionByName(found.select(*columns)), "ranks")
    return targets.select(*(F.col(a).alias(c) for a, c in zip(g, group_cols)), "n", "idx", F.col("lo").alias("value"))


def count_table(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null (group, value) rows with their count ``_n`` (partial
    aggregation; the shuffle key includes the value, so a hot group spreads
    over many tasks)."""
    return (
        df.where(F.col(value_col).isNotNull()).groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_n"))
    )


def cumulative_counts(
    df: DataFrame, value_col: str, group_cols: Sequence[str] = (), num_partitions: int | None = None
) -> DataFrame:
    """One row per distinct non-null (group, value):
    ``group..., value, n, n_before, n_group`` with exact counts, by the
    range-partitioned prefix sums of the module docstring."""
    return _ranged_cumulative(count_table(df, value_col, group_cols), value_col, list(group_cols), num_partitions)


def _ranged_cumulative(counts: DataFrame, value_col: str, g: list[str], num_partitions: int | None) -> DataFrame:
    spark = counts.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        counts.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in g + [value_col]])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in g + [value_col]])
        .withColumn("_pid", F.spark_partition_id())
    )
    schema = T.StructType(ranged.schema.fields + [T.StructField("_local_before", T.LongType(), False)])
    local = measured(ranged.mapInPandas(_local_prefix(g), schema), "prefix")
    totals = local.groupBy("_pid", *g).agg(F.sum("_n").alias("_pn"))
    by_group = Window.partitionBy(*g) if g else Window.partitionBy()
    offsets = totals.select(
        "_pid", *g,
        F.coalesce(
            F.sum("_pn").over(by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
        F.sum("_pn").over(by_group).alias("n_group"),
    )
    off = offsets.alias("o")
    loc = local.alias("l")
    cond = F.col("l._pid") == F.col("o._pid")
    for c in g:
        cond = cond & F.col(f"l.{c}").eqNullSafe(F.col(f"o.{c}"))
    return loc.join(off, cond).select(
        *[F.col(f"l.{c}").alias(c) for c in g],
        F.col(f"l.{value_col}").alias(value_col),
        F.col("l._n").alias("n"),
        (F.col("o._off") + F.col("l._local_before")).alias("n_before"),
        F.col("o.n_group").alias("n_group"),
    )


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    approx: bool = False,
    accuracy: int = 100_000,
) -> DataFrame:
    """Linear-interpolated quantiles (pandas / ``quantile_cont`` semantics).

    Returns a long table ``group..., p_idx int, p double, q double``.
    ``approx=True`` switches to the mergeable ``percentile_approx`` sketch.
    """
    g = list(group_cols)
    probs = [float(p) for p in probs]
    at = F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("p_idx") + 1)
    if approx:
        agg = df.groupBy(*g).agg(
            F.percentile_approx(F.col(value_col).cast("double"), probs, accuracy).alias("_qs")
        )
        return agg.select(*g, F.posexplode("_qs").alias("p_idx", "q")).withColumn("p", at)

    def ranks(n: Column) -> list[Column]:
        places = [(n - 1) * F.lit(p) for p in probs]
        return [r for x in places for r in (F.floor(x), F.ceil(x))]

    stats = order_statistics(df, value_col, ranks, g).withColumn("p_idx", (F.col("idx") / 2).cast("int"))
    place = (F.max("n") - 1) * F.max(at)
    below = F.max(F.when(F.col("idx") % 2 == 0, F.col("value")))
    above = F.max(F.when(F.col("idx") % 2 == 1, F.col("value")))
    return stats.groupBy(*g, "p_idx").agg(
        F.max(at).alias("p"), (below + (above - below) * (place - F.floor(place))).alias("q")
    )


def quantile_array(
    df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """``group..., qs array<double>`` ordered like ``probs``."""
    g = list(group_cols)
    q = exact_quantiles(df, value_col, probs, g, approx=approx)
    return q.groupBy(*g).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("p_idx", "q"))), lambda s: s["q"]).alias("qs")
    )


def group_median(df: DataFrame, value_col: str, group_cols: Sequence[str], approx: bool = False) -> DataFrame:
    q = exact_quantiles(df, value_col, [0.5], group_cols, approx=approx)
    return q.select(*group_cols, F.col("q").alias("median"))


def modes(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Most frequent non-null value per group; ties -> smallest value.  ``weight``
    names a column that counts the rows a row stands for.

    Two partial aggregations (count per (group, value), then ``min_by`` per
    group), so neither a hot group nor a wide value domain lands in one map.
    """
    g = list(group_cols)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value_col).isNotNull()).groupBy(*g, value_col).agg(n.alias("_n"))
    return counts.groupBy(*g).agg(
        F.min_by(F.col(value_col), F.struct(-F.col("_n"), F.col(value_col))).alias("mode"),
        F.max("_n").alias("mode_count"),
    )


def dense_codes(df: DataFrame, value_col: str, code_col: str = "code") -> DataFrame:
    """Alphabetical 0-based code of every distinct non-null value (``value, code``).

    The rank over distinct values is the exact distributed prefix count above
    (weight 1 per distinct value), not a global window.
    """
    distinct = df.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    cc = cumulative_counts(distinct, value_col)
    return cc.select(value_col, F.col("n_before").alias(code_col))


def average_ranks(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Average rank (ties share the mean rank, 1-based) per distinct value.  With
    ``weight`` the rows are distinct values already and that column counts them."""
    if weight is None:
        cc = cumulative_counts(df, value_col, group_cols)
    else:
        counted = df.where(F.col(value_col).isNotNull()).select(*group_cols, value_col, F.col(weight).alias("_n"))
        cc = _ranged_cumulative(counted, value_col, list(group_cols), None)
    return cc.select(
        *group_cols, value_col,
        (F.col("n_before") + (F.col("n") + 1) / 2.0).alias("avg_rank"),
    )
