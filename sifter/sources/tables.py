"""Bindings of the operators to the driver tables (``/root/testdata/sf*``).

The house-sale table the reference reads is not shipped, so the operators are
exercised on ``sale``: one row per order, with a group key, an ordinal
quality, natural nulls from a left join and a numeric target.  The Spark plan
below and ``SALE_SQL`` (used by the DuckDB oracle) define the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Column roles of ``sale`` (house-sale role in brackets):
#   sale_id [Id], nbhd [Neighborhood], zone [MSZoning], qual [ExterQual, ordinal],
#   cond [Electrical, mode fill], yr_sold [YrSold], yr_built [YearBuilt],
#   area [LotFrontage, null without lines], n_items, garage_type [GarageType],
#   garage_yr [GarageYrBlt], acctbal, price [SalePrice].
SALE_COLUMNS = [
    "sale_id", "nbhd", "zone", "qual", "cond", "yr_sold", "yr_built",
    "area", "n_items", "garage_type", "garage_yr", "acctbal", "price",
]
SALE_NUMERIC = ["yr_sold", "yr_built", "area", "n_items", "garage_yr", "acctbal", "price"]
SALE_TEXT = ["nbhd", "zone", "qual", "cond", "garage_type"]


def line_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line aggregates (partial aggregation before the shuffle)."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("area"),
        F.count(F.lit(1)).alias("n_items"),
        F.min("l_returnflag").alias("garage_type"),
        F.max(F.year("l_shipdate")).cast("int").alias("garage_yr"),
    )


def sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``sale`` view (FIXTURES.md §3.1) as one lazy DataFrame plan.

    Joins: orders-customer on the customer key and orders-lines on the order
    key are shuffle joins chosen by Catalyst/AQE (both sides grow with the
    data); nation is a dimension that the optimizer broadcasts from its
    measured size.  Only the referenced columns reach the parquet scans.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = line_summary(spark, sf_dir)
    joined = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    return joined.select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("n_name").alias("nbhd"),
        F.col("c_mktsegment").alias("zone"),
        F.col("o_orderpriority").alias("qual"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.col("o_orderstatus")).alias("cond"),
        F.year("o_orderdate").cast("int").alias("yr_sold"),
        (F.year("o_orderdate") - F.pmod(F.col("o_custkey"), F.lit(60))).cast("int").alias("yr_built"),
        F.col("area"),
        F.col("n_items"),
        F.col("garage_type"),
        F.when(F.col("n_items") == 1, F.lit(None).cast("int")).otherwise(F.col("garage_yr")).alias("garage_yr"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("o_totalprice").alias("price"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


SALE_SQL = """
select o.o_orderkey as sale_id, n.n_name as nbhd, c.c_mktsegment as zone, o.o_orderpriority as qual,
       case when o.o_orderstatus = 'P' then null else o.o_orderstatus end as cond,
       cast(year(o.o_orderdate) as int) as yr_sold,
       cast(year(o.o_orderdate) - o.o_custkey % 60 as int) as yr_built,
       l.area, l.n_items, l.garage_type,
       case when l.n_items = 1 then null else l.garage_yr end as garage_yr,
       c.c_acctbal as acctbal, o.o_totalprice as price
from orders o join customer c on o.o_custkey = c.c_custkey
     join nation n on c.c_nationkey = n.n_nationkey
     left join (select l_orderkey, sum(l_quantity) as area, count(*) as n_items, min(l_returnflag) as garage_type,
                       cast(max(year(l_shipdate)) as int) as garage_yr
                from lineitem group by l_orderkey) l on l.l_orderkey = o.o_orderkey
"""


def with_sale(sql: str) -> str:
    """Prefix an oracle query with the ``sale`` CTE (merging a leading WITH)."""
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive sale as ({SALE_SQL}),\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with sale as ({SALE_SQL}),\n{body[5:]}"
    return f"with sale as ({SALE_SQL})\n{body}"
