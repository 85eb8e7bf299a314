"""Bound queries: sources, projection, predicates, imputation, joins, set ops."""

from __future__ import annotations

from pyspark.sql import functions as F

from sifter.functions.exprs import flag, null_false
from sifter.operators import columns as cols_op
from sifter.operators import impute, joins
from sifter.operators.ranks import measured
from sifter.plans.common import R, finish, own, sale, with_sale
from sifter.session import scratch_path
from sifter.sources import files
from sifter.sources.tables import SALE_COLUMNS

QUERIES: dict = {}
ORACLE: dict = {}


def query(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_sale(sql)
        return fn

    return deco


# ---- sources -------------------------------------------------------------
CSV_SCHEMA = "sale_id bigint, nbhd string, cond string, area double, garage_yr int"


@query("csv_sentinel_scan", "select sale_id, nbhd, cond, area, garage_yr from sale")
def csv_sentinel_scan(spark, d):
    """Write a projection of ``sale`` as CSV with pandas-style null sentinels
    (``NA`` for text, ``None`` for numbers) to the shared checkpoint folder and
    read it back with the sentinel-aware reader."""
    s = sale(spark, d)
    path = scratch_path(spark, "csv")
    spellings = F.array(*[F.lit(x) for x in ("None", "NaN", "N/A", "-nan")])
    other_null = F.element_at(spellings, (F.pmod("sale_id", F.lit(4)) + 1).cast("int"))
    files.write_csv(
        s.select(
            F.col("sale_id").cast("string").alias("sale_id"),
            F.coalesce(F.col("nbhd"), F.lit("NA")).alias("nbhd"),
            F.coalesce(F.col("cond"), F.lit("NA")).alias("cond"),
            F.coalesce(F.col("area").cast("string"), other_null).alias("area"),
            F.coalesce(F.col("garage_yr").cast("string"), F.lit("n/a")).alias("garage_yr"),
        ),
        path,
    )
    return files.read_csv(spark, path, CSV_SCHEMA)


MIXED_SQL = "case when sale_id % 1000 = 0 then 'n' || sale_id else cast(sale_id as varchar) end"


def _untyped_csv(spark, d):
    """A CSV of ``sale`` with a column of every inferred type."""
    path = scratch_path(spark, "csv")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NA"))
    s = sale(spark, d).select(
        "sale_id", text("nbhd").alias("nbhd"), text("area").alias("area"), text("garage_yr").alias("garage_yr"),
        F.when(F.col("qual") == "1-URGENT", "True").otherwise("False").alias("urgent"),
        F.when(F.col("sale_id") % 1000 == 0, F.concat(F.lit("n"), F.col("sale_id"))).otherwise(F.col("sale_id").cast("string")).alias("mixed"),
        F.lit("null").alias("void"),
    )
    files.write_csv(s, path)
    return path


@query(
    "csv_inferred_scan",
    f"""select sale_id, nbhd, cast(area as double) as area, cast(garage_yr as double) as garage_yr,
        qual = '1-URGENT' as urgent, {MIXED_SQL} as mixed, cast(null as double) as void from sale""",
)
def csv_inferred_scan(spark, d):
    """A1 without a schema: types by all rows, as pandas infers them."""
    return files.read_csv(spark, _untyped_csv(spark, d))


@query(
    "csv_type_report",
    """select name, n, n_null, type from (
        select 'sale_id' as name, count(*) as n, cast(0 as bigint) as n_null, 'int' as type from sale union all
        select 'nbhd', count(*), count(*) - count(nbhd), 'text' from sale union all
        select 'area', count(*), count(*) - count(area), 'double' from sale union all
        select 'garage_yr', count(*), count(*) - count(garage_yr), 'double' from sale union all
        select 'urgent', count(*), 0, 'bool' from sale union all
        select 'mixed', count(*), 0, 'text' from sale union all
        select 'void', count(*), count(*), 'double' from sale)""",
)
def csv_type_report(spark, d):
    """A1: what the types were inferred from."""
    raw = spark.read.option("header", True).csv(_untyped_csv(spark, d))
    return files.text_profile(raw).select("name", "n", "n_null", "type")


@query(
    "csv_head",
    "select sale_id, nbhd from sale order by sale_id limit 7",
)
def csv_head(spark, d):
    """A4: the first rows in file order, of a file in order of sale_id."""
    path = scratch_path(spark, "csv")
    files.write_csv(sale(spark, d).select("sale_id", "nbhd").repartitionByRange(5, "sale_id").sortWithinPartitions("sale_id"), path)
    return files.head(spark.read.option("header", True).schema("sale_id bigint, nbhd string").csv(path), 7)


@query(
    "missing_source",
    "select 'nation' as source, count(*) as n_rows from nation union all select 'absent', cast(0 as bigint)",
)
def missing_source(spark, d):
    """A2: a source that is there and one that is not, read alike."""
    schema = "n_nationkey int, n_name string"
    parts = [
        files.read_or_empty(spark, f"{d}/{path}.parquet", schema, fmt="parquet").agg(
            F.lit(name).alias("source"), F.count(F.lit(1)).alias("n_rows")
        )
        for name, path in (("nation", "nation"), ("absent", "no_such_table"))
    ]
    return parts[0].unionByName(parts[1])


@query("preview_rows", "select * from sale order by sale_id limit 10")
def preview_rows(spark, d):
    return files.preview(sale(spark, d), "sale_id", 10)


@query("shape_report", f"select count(*) as n_rows, cast({len(SALE_COLUMNS)} as bigint) as n_cols from sale")
def shape_report(spark, d):
    return files.shape(sale(spark, d))


# ---- projection / predicates ----------------------------------------------
@query("column_range", "select zone, qual, cond, yr_sold, yr_built from sale")
def column_range(spark, d):
    return cols_op.column_range(sale(spark, d), "zone", "yr_built")


@query(
    "drop_columns",
    "select sale_id, nbhd, zone, qual, cond, yr_sold, yr_built, area, n_items, garage_yr, price from sale",
)
def drop_columns(spark, d):
    return cols_op.drop_columns(sale(spark, d), ["acctbal", "garage_type", "not_a_column"])


ALIGN_COLUMNS = ["sale_id", "nbhd", "qual", "zone_code", "area", "n_items", "garage_yr", "yr_built"]


@query(
    "align_columns",
    """select coalesce(sale_id, 0) as sale_id, nbhd, qual, cast(0 as double) as zone_code,
              coalesce(area, 0) as area, coalesce(n_items, 0) as n_items,
              coalesce(garage_yr, 0) as garage_yr, coalesce(yr_built, 0) as yr_built
       from sale""",
)
def align_columns(spark, d):
    test = cols_op.drop_columns(sale(spark, d), ["price"])
    return cols_op.align_columns(test, ALIGN_COLUMNS, category_cols=["nbhd", "qual"])


@query("threshold_filter_null_safe", "select * from sale where not coalesce(area > 150 or acctbal > 9000, false)")
def threshold_filter_null_safe(spark, d):
    s = sale(spark, d)
    return s.where(~null_false((F.col("area") > 150) | (F.col("acctbal") > 9000)))


@query(
    "membership_flags",
    """select sale_id,
        case when zone in ('BUILDING', 'MACHINERY') then 1 else 0 end as zone_crit,
        case when coalesce(qual in ('1-URGENT', '2-HIGH') or cond in ('F'), false) then 1 else 0 end as near_negative,
        case when coalesce(n_items < 3 and yr_built < 1950, false) then 1 else 0 end as is_distressed,
        case when coalesce(yr_built < 1950 and acctbal >= 7000, false) then 1 else 0 end as old_high_cond
       from sale""",
)
def membership_flags(spark, d):
    s = sale(spark, d)
    return s.select(
        "sale_id",
        flag(F.col("zone").isin("BUILDING", "MACHINERY")).alias("zone_crit"),
        flag(F.col("qual").isin("1-URGENT", "2-HIGH") | F.col("cond").isin("F")).alias("near_negative"),
        flag((F.col("n_items") < 3) & (F.col("yr_built") < 1950)).alias("is_distressed"),
        flag((F.col("yr_built") < 1950) & (F.col("acctbal") >= 7000)).alias("old_high_cond"),
    )


@query("dropna_subset", "select * from sale where area is not null and garage_yr is not null")
def dropna_subset(spark, d):
    return cols_op.dropna_subset(sale(spark, d), ["area", "garage_yr"])


# ---- imputation -------------------------------------------------------------
@query(
    "conditional_fill",
    """select sale_id, coalesce(garage_type, 'NA') as garage_type,
              case when coalesce(garage_type, 'NA') = 'NA' then coalesce(garage_yr, 0)
                   else coalesce(garage_yr, yr_built) end as garage_yr
       from sale""",
)
def conditional_fill(spark, d):
    s = impute.fill_text(sale(spark, d), ["garage_type"])
    s = impute.conditional_fill(s, "garage_yr", "garage_type", "NA", "yr_built")
    return s.select("sale_id", "garage_type", "garage_yr")


@query(
    "constant_fill",
    "select sale_id, coalesce(garage_type, 'NA') as garage_type, coalesce(cond, 'NA') as cond, "
    "coalesce(area, 0) as area from sale",
)
def constant_fill(spark, d):
    s = impute.fill_text(sale(spark, d), ["garage_type", "cond", "not_a_column"])
    s = impute.fill_number(s, ["area"], 0)
    return s.select("sale_id", "garage_type", "cond", "area")


@query(
    "group_median_impute",
    """select s.sale_id, s.nbhd, coalesce(s.area, m.med) as area
       from sale s left join (select nbhd, quantile_cont(area, 0.5) as med from sale group by nbhd) m
       on s.nbhd = m.nbhd""",
)
def group_median_impute(spark, d):
    s = impute.group_median_fill(own(sale(spark, d).select("sale_id", "nbhd", "area")), "area", ["nbhd"])
    return finish(s.select("sale_id", "nbhd", "area"))


MODE_SQL = "(select {c} from sale where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"


@query("mode_impute", f"select sale_id, coalesce(cond, {MODE_SQL.format(c='cond')}) as cond from sale")
def mode_impute(spark, d):
    return impute.mode_fill(sale(spark, d), ["cond"]).select("sale_id", "cond")


@query(
    "global_fallback_impute",
    f"""with m as (select quantile_cont(area, 0.5) as a, quantile_cont(n_items, 0.5) as n,
                          quantile_cont(garage_yr, 0.5) as g from sale)
        select sale_id, nbhd, zone, qual, coalesce(cond, {MODE_SQL.format(c='cond')}) as cond, yr_sold, yr_built,
               {R('coalesce(area, m.a)', 'area')}, {R('coalesce(cast(n_items as double), m.n)', 'n_items')},
               coalesce(garage_type, {MODE_SQL.format(c='garage_type')}) as garage_type,
               {R('coalesce(cast(garage_yr as double), m.g)', 'garage_yr')}, acctbal, price
        from sale, m""",
)
def global_fallback_impute(spark, d):
    return finish(impute.global_fallback(own(sale(spark, d))))


def _missing_profile_sql():
    parts = [
        f"select '{c}' as \"column\", cast(sum(case when {c} is null then 1 else 0 end) as bigint) as total, "
        f"count(*) as n from sale"
        for c in SALE_COLUMNS
    ]
    u = " union all ".join(parts)
    return (
        f"select \"column\", total, {R('cast(total as double) * 100.0 / n', 'percent')} "
        f"from ({u}) t where total > 0"
    )


@query("missing_profile", _missing_profile_sql())
def missing_profile(spark, d):
    return finish(impute.missing_profile(sale(spark, d)))


def _null_audit_sql():
    after = {c: c for c in SALE_COLUMNS}
    after["garage_type"] = "coalesce(garage_type, 'NA')"
    after["cond"] = "coalesce(cond, 'NA')"
    after["area"] = "coalesce(area, 0)"
    before = " + ".join(f"sum(case when {c} is null then 1 else 0 end)" for c in SALE_COLUMNS)
    aft = " + ".join(f"sum(case when {e} is null then 1 else 0 end)" for e in after.values())
    return f"select cast({before} as bigint) as nulls_before, cast({aft} as bigint) as nulls_after from sale"


@query("null_audit", _null_audit_sql())
def null_audit(spark, d):
    """C11 before and after the constant fills, in one aggregation."""
    s = sale(spark, d)
    cleaned = {
        "garage_type": F.coalesce(F.col("garage_type"), F.lit("NA")),
        "cond": F.coalesce(F.col("cond"), F.lit("NA")),
        "area": F.coalesce(F.col("area"), F.lit(0.0)),
    }
    return impute.null_totals_before_after(s, cleaned)


# ---- joins / set operations -------------------------------------------------
ZONE_LEVEL = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}


@query(
    "lookup_map_default",
    "select sale_id, zone, case zone "
    + " ".join(f"when '{k}' then {v}" for k, v in ZONE_LEVEL.items())
    + " else 0 end as zone_level from sale",
)
def lookup_map_default(spark, d):
    s = joins.lookup(sale(spark, d), "zone", ZONE_LEVEL, "zone_level", default=0)
    return s.select("sale_id", "zone", "zone_level")


@query(
    "aligned_append",
    f"""select s.sale_id, s.nbhd, {R('s.price / m.mean_price', 'price_ratio')}
        from sale s join (select nbhd, avg(price) as mean_price from sale group by nbhd) m on s.nbhd = m.nbhd""",
)
def aligned_append(spark, d):
    s = sale(spark, d)
    means = measured(s.groupBy("nbhd").agg(F.avg("price").alias("mean_price")), "group-means")
    out = joins.append_by_key(s.select("sale_id", "nbhd", "price"), means, "nbhd")
    return finish(out.select("sale_id", "nbhd", (F.col("price") / F.col("mean_price")).alias("price_ratio")))


RULE_A = "area > 150"
RULE_B = "acctbal > 9000"


def _rule_keys(s):
    a = s.where(F.col("area") > 150).select("sale_id")
    b = s.where(F.col("acctbal") > 9000).select("sale_id")
    return joins.union_keys(a, b)


@query(
    "outlier_union_keys",
    f"select sale_id from sale where {RULE_A} union select sale_id from sale where {RULE_B}",
)
def outlier_union_keys(spark, d):
    return _rule_keys(sale(spark, d))


@query(
    "anti_join_outliers",
    f"""select sale_id, nbhd, price from sale s where not exists (
          select 1 from (select sale_id from sale where {RULE_A} union select sale_id from sale where {RULE_B}) k
          where k.sale_id = s.sale_id)""",
)
def anti_join_outliers(spark, d):
    s = sale(spark, d)
    return joins.remove_keys(s, _rule_keys(s), "sale_id").select("sale_id", "nbhd", "price")


@query(
    "concat_split_tag",
    """select *, 'train' as split from sale where yr_sold <= 1998
       union all
       select sale_id, nbhd, zone, qual, cond, yr_sold, yr_built, area, n_items, garage_type, garage_yr, acctbal,
              null as price, 'test' as split from sale where yr_sold > 1998""",
)
def concat_split_tag(spark, d):
    s = sale(spark, d)
    train = s.where(F.col("yr_sold") <= 1998)
    test = s.where(F.col("yr_sold") > 1998).drop("price")
    return joins.concat_tagged({"train": train, "test": test})


@query(
    "split_by_tag",
    """select yr_sold, count(*) as n, count(cast(null as double)) as n_with_target from sale where yr_sold > 1998
       group by yr_sold""",
)
def split_by_tag(spark, d):
    """Split the concatenated frame back by its tag column."""
    both = concat_split_tag(spark, d)
    test = joins.split_tagged(both, "test")
    return test.groupBy("yr_sold").agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("n_with_target"))
