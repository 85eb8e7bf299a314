"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.session import scratch_path

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Cells of the two-level numbering. Fixed, so that numbers do not depend on the cluster.
NUMBER_BUCKETS = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def quoted(name: str) -> Column:
    """The column of that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as keep it from clashing with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return memory that a task has freed to the system, where the C library can: a Python worker
    outlives its task, and the next one's memory comes on top."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back: lineage is cut, and a lost
    executor costs no more than the tasks it ran."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def number_rows(df: DataFrame, group: list[str], order: list[str], out: str, then: tuple[str, ...] = ()) -> DataFrame:
    """Number the rows of each group from 0, gapless, in an order fixed by ``order``'s hash; rows that
    are equal there stand together, in the order of ``then``.

    Two levels: a row falls in one of ``NUMBER_BUCKETS`` cells by the hash of ``order``; cells are
    counted and offset first, so a group holding most rows is still numbered by many tasks.  Rows
    equal in all these columns get different numbers in no fixed order.  ``df`` is read twice.
    """
    cell = f"__{out}_cell"
    cells = df.withColumn(cell, F.pmod(F.xxhash64(*order), F.lit(NUMBER_BUCKETS)))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, cell]
    counts = cells.groupBy(*keys).agg(F.count("*").alias("__n"))
    if not group:  # at most NUMBER_BUCKETS rows
        before = Window.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    on = cells[cell].eqNullSafe(offsets[cell])
    for g in group:
        on = on & cells[g].eqNullSafe(offsets[g])
    inside = Window.partitionBy(*(cells[k] for k in keys)).orderBy(*(cells[c] for c in (*order, *then)))
    joined = cells.join(offsets, on)
    return joined.select(
        *(cells[c] for c in df.columns),
        (offsets["__before"] + F.row_number().over(inside) - 1).cast("long").alias(out),
    )
