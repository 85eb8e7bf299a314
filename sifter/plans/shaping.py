"""Bound queries: feature columns, encodings and discretization."""

from __future__ import annotations

from pyspark.sql import functions as F

from sifter.functions.exprs import LABELS_5, MISSING_TEXT, flag
from sifter.operators import binning, features, impute
from sifter.plans.common import (
    R, finish, own, probs_sql, sale, sql_bin, sql_equal_width, sql_labels, sql_list, with_sale,
)
from sifter.session import scratch_path
from sifter.sources import files
from sifter.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}


def query(name, sql=None, cte=True):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_sale(sql) if cte else sql
        return fn

    return deco


# ---- D1-D9 feature block -----------------------------------------------------------
NEG_QUAL = ["1-URGENT", "2-HIGH"]
CRIT_ZONE = ["BUILDING", "MACHINERY"]


@query(
    "feature_block",
    f"""select sale_id,
        area + n_items as total_sf,
        n_items * area as qual_area,
        {R('area + 0.5 * n_items', 'weighted_sum')},
        yr_sold - yr_built as house_age,
        yr_sold - garage_yr as years_since_garage,
        case when coalesce(yr_built = yr_sold, false) then 1 else 0 end as is_new,
        {R('area + n_items + acctbal', 'porch_total')},
        case when coalesce(garage_yr > 0, false) then 1 else 0 end as has_garage,
        case when coalesce(n_items > 3, false) then 1 else 0 end as has_many_items,
        case when coalesce(n_items < 3 and acctbal < 0, false) then 1 else 0 end as is_distressed,
        case when coalesce(qual in ({sql_list(NEG_QUAL)}) or cond in ('F'), false) then 1 else 0 end as near_negative,
        case when coalesce(zone in ({sql_list(CRIT_ZONE)}), false) then 1 else 0 end as zoning_crit
       from sale""",
)
def feature_block(spark, d):
    s = sale(spark, d)
    return finish(s.select(
        "sale_id",
        features.total("area", "n_items").alias("total_sf"),
        features.product("n_items", "area").alias("qual_area"),
        features.weighted_sum({"area": 1, "n_items": 0.5}).alias("weighted_sum"),
        features.age(s, "yr_built", "yr_sold").alias("house_age"),
        features.age(s, "garage_yr", "yr_sold").alias("years_since_garage"),
        features.equal_flag("yr_built", "yr_sold").alias("is_new"),
        features.total("area", "n_items", "acctbal").alias("porch_total"),
        features.positive_flag(F.col("garage_yr")).alias("has_garage"),
        flag(F.col("n_items") > 3).alias("has_many_items"),
        flag((F.col("n_items") < 3) & (F.col("acctbal") < 0)).alias("is_distressed"),
        features.member_flag(("qual", NEG_QUAL), ("cond", ["F"])).alias("near_negative"),
        features.member_flag(("zone", CRIT_ZONE)).alias("zoning_crit"),
    ))


@query(
    "log_expm1_clamp",
    f"""select sale_id, {R('ln(1 + price)', 'y_log')}, {R('exp(ln(1 + price)) - 1', 'back')},
              {R('greatest(exp(ln(1 + price) - 12) - 1, 0.0)', 'clamped')}
       from sale""",
)
def log_expm1_clamp(spark, d):
    s = sale(spark, d)
    y = F.log1p("price")
    return finish(s.select(
        "sale_id", y.alias("y_log"), F.expm1(y).alias("back"),
        features.clamp_non_negative(F.expm1(y - 12)).alias("clamped"),
    ))


@query("time_bucket", "select sale_id, cast(floor(yr_built / 10) * 10 as bigint) as decade from sale")
def time_bucket(spark, d):
    return sale(spark, d).select("sale_id", features.decade("yr_built").alias("decade"))


@query(
    "try_numeric",
    """select sale_id, try_cast(case when cond is null then 'unknown' else cast(yr_built as varchar) end as double)
              as year_num from sale""",
)
def try_numeric(spark, d):
    s = sale(spark, d).select(
        "sale_id",
        F.when(F.col("cond").isNull(), F.lit("unknown")).otherwise(F.col("yr_built").cast("string")).alias("raw"),
    )
    return s.select("sale_id", features.try_number("raw").alias("year_num"))


# ---- E1-E5 encodings ----------------------------------------------------------------
# Ordinal maps for the bound columns (highest priority -> highest code).
QUAL_MAP = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1, "5-LOW": 0}
COND_MAP = {"F": 2, "O": 1}


def _case(c, m):
    return f"coalesce(case {c} " + " ".join(f"when '{k}' then {v}" for k, v in m.items()) + " end, 0)"


@query(
    "ordinal_encode",
    f"select sale_id, {_case('qual', QUAL_MAP)} as qual, {_case('cond', COND_MAP)} as cond from sale",
)
def ordinal_encode(spark, d):
    s = sale(spark, d).select("sale_id", "qual", "cond")
    return features.ordinal_encode(s, {"qual": QUAL_MAP, "cond": COND_MAP}, unmapped=0)


def _code_sql(c):
    return (f"coalesce((select code from (select {c} as v, cast(dense_rank() over (order by {c}) - 1 as bigint) as code "
            f"from (select distinct {c} from sale where {c} is not null)) t where t.v = s.{c}), -1)")


@query(
    "factorize",
    f"select sale_id, {_code_sql('nbhd')} as nbhd_code, {_code_sql('cond')} as cond_code from sale s",
)
def factorize(spark, d):
    s = sale(spark, d).select("sale_id", "nbhd", "cond")
    out = features.factorize(s, ["nbhd", "cond"], suffix="_code")
    return out.select("sale_id", "nbhd_code", "cond_code")


def _first_code_sql(c):
    return (f"coalesce((select code from (select v, cast(row_number() over (order by p) - 1 as bigint) as code "
            f"from (select {c} as v, min(sale_id) as p from sale where {c} is not null group by {c})) t where t.v = s.{c}), -1)")


@query(
    "factorize_first_seen",
    f"select sale_id, {_first_code_sql('nbhd')} as nbhd_code, {_first_code_sql('cond')} as cond_code from sale s",
)
def factorize_first_seen(spark, d):
    """Codes by first appearance in a CSV in order of sale_id, rows numbered in file order."""
    path = scratch_path(spark, "csv")
    s = sale(spark, d).select("sale_id", "nbhd", "cond")
    files.write_csv(s.repartitionByRange(5, "sale_id").sortWithinPartitions("sale_id"), path)
    rows = files.read_csv_in_order(spark, path, "sale_id bigint, nbhd string, cond string")
    out = features.factorize(rows, ["nbhd", "cond"], suffix="_code", order_col=files.ROW_INDEX)
    return out.select("sale_id", "nbhd_code", "cond_code")


@query(
    "one_hot_drop_first",
    """select sale_id,
        case when zone = 'BUILDING' then 1 else 0 end as zone_BUILDING,
        case when zone = 'FURNITURE' then 1 else 0 end as zone_FURNITURE,
        case when zone = 'HOUSEHOLD' then 1 else 0 end as zone_HOUSEHOLD,
        case when zone = 'MACHINERY' then 1 else 0 end as zone_MACHINERY,
        case when cond = 'O' then 1 else 0 end as cond_O
       from sale""",
)
def one_hot_drop_first(spark, d):
    s = sale(spark, d).select("sale_id", "zone", "cond")
    return features.one_hot_drop_first(s, ["zone", "cond"])


STD_COLS = ["area", "acctbal", "n_items"]


def _std_sql():
    stats = ", ".join(f"avg(coalesce({c}, 0)) as m_{c}, stddev_pop(coalesce({c}, 0)) as s_{c}" for c in STD_COLS)
    cols = ", ".join(
        R(f"(coalesce({c}, 0) - m_{c}) / (case when s_{c} = 0 then 1 else s_{c} end)", c) for c in STD_COLS
    )
    return f"with st as (select {stats} from sale) select sale_id, {cols} from sale, st"


@query("standardize", _std_sql())
def standardize(spark, d):
    s = sale(spark, d).select("sale_id", *STD_COLS)
    return finish(features.standardize(s, STD_COLS, fill=0.0))


CODE_COLS = ["nbhd", "zone", "qual", "cond"]


def _codes_sql():
    parts = []
    for c in CODE_COLS:
        parts.append(
            f"""coalesce((select cast(code as double) from (select v, dense_rank() over (order by v) - 1 as code
                          from (select distinct {c} as v from sale where yr_sold <= 1998 and {c} is not null)) t
                          where t.v = s.{c}),
                         (select cast(count(distinct {c}) as double) from sale where yr_sold <= 1998)) as {c}_code"""
        )
    return f"select sale_id, {', '.join(parts)} from sale s"


@query("category_codes", _codes_sql())
def category_codes(spark, d):
    """Category codes fitted on the training part (yr_sold <= 1998) and
    applied to every row; unseen values and nulls get the extra index."""
    s = sale(spark, d).select("sale_id", "yr_sold", *CODE_COLS)
    codes = features.CategoryCodes(s.where(F.col("yr_sold") <= 1998), CODE_COLS)
    return codes.transform(s).select("sale_id", *[f"{c}_code" for c in CODE_COLS])


@query(
    "placeholder_fill",
    "select sale_id, coalesce(cond, 'missing') as cond, coalesce(garage_type, 'missing') as garage_type from sale",
)
def placeholder_fill(spark, d):
    """Placeholder category before encoding/scoring."""
    s = sale(spark, d).select("sale_id", "cond", "garage_type")
    return impute.fill_text(s, ["cond", "garage_type"], MISSING_TEXT)


# ---- F1-F7 discretization ---------------------------------------------------------------
QCUT_COLS = ["area", "acctbal", "yr_built", "n_items"]


def _qcut_sql():
    parts = []
    for c in QCUT_COLS:
        parts.append(
            f"""e_{c} as (select case when len(list_distinct(q)) < len(q) then {sql_equal_width('mn', 'mx', 5)}
                                    else q end as e
                           from (select quantile_cont({c}, {probs_sql(5)}) as q, min({c}) as mn, max({c}) as mx
                                 from sale))"""
        )
    parts.append(f"e_price as (select quantile_cont(price, {probs_sql(5)}) as e from sale)")
    sel = ", ".join(
        f"{sql_labels(LABELS_5)}[{sql_bin(f's.{c}', f'e_{c}.e')}] as {c}" for c in QCUT_COLS
    )
    frm = ", ".join(f"e_{c}" for c in QCUT_COLS)
    return (
        "with " + ",\n".join(parts)
        + f"\nselect s.sale_id, {sel}, {sql_labels(LABELS_5)}[{sql_bin('s.price', 'e_price.e')}] as priceBin "
        f"from sale s, {frm}, e_price"
    )


@query("qcut_labels", _qcut_sql())
def qcut_labels(spark, d):
    s = own(sale(spark, d).select("sale_id", *QCUT_COLS, "price"))
    plan = binning.fit_discretize(s, target="price", bins=5, id_col="sale_id", cols=QCUT_COLS)
    return plan.transform(s).drop("price")


@query(
    "cut_fallback",
    f"""with f as (select cast(l_quantity > 40 as int) as big from lineitem),
        q as (select quantile_cont(big, {probs_sql(5)}) as q, min(big) as mn, max(big) as mx from f),
        e as (select case when len(list_distinct(q)) < len(q) then {sql_equal_width('mn', 'mx', 5)} else q end as e
              from q)
        select big, {sql_labels(LABELS_5)}[{sql_bin('big', 'e.e')}] as big_bin, count(*) as n
        from f, e group by all""",
    cte=False,
)
def cut_fallback(spark, d):
    """F2 via F1: a 0/1 flag's quantile edges repeat, so equal-width bins apply."""
    li = table(spark, d, "lineitem").select((F.col("l_quantity") > 40).cast("int").alias("big"))
    plan = binning.fit_discretize(li, target="__none__", bins=5, id_col="__none__", cols=["big"])
    binned = li.select("big", plan.expr("big").alias("big_bin"))
    return binned.groupBy("big", "big_bin").agg(F.count(F.lit(1)).alias("n"))


@query(
    "qcut_merged_codes",
    f"""with e as (select list_sort(list_distinct(quantile_cont(l_tax, {probs_sql(4)}))) as e from lineitem)
        select cast({sql_bin('l_tax', 'e.e')} - 1 as int) as tax_code, count(*) as n, {R('min(l_tax)', 'lo')},
               {R('max(l_tax)', 'hi')}
        from lineitem, e group by all""",
    cte=False,
)
def qcut_merged_codes(spark, d):
    """quartile codes of ``l_tax`` whose repeated edges are merged."""
    li = table(spark, d, "lineitem").select("l_tax")
    coded = binning.qcut_codes(li, "l_tax", 4, out_col="tax_code")
    return finish(coded.groupBy("tax_code").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_tax").alias("lo"), F.max("l_tax").alias("hi")
    ))


@query(
    "histogram_bins",
    f"""with st as (select min(value) as mn, max(value) as mx from events),
        e as (select {sql_equal_width('mn', 'mx', 10)} as e from st),
        b as (select {sql_bin('value', 'e.e')} as bin from events, e where value is not null),
        c as (select bin, count(*) as n from b group by bin)
        select cast(i + 1 as int) as bin, {R('e.e[i + 1]', 'lo')}, {R('e.e[i + 2]', 'hi')},
               cast(coalesce(c.n, 0) as bigint) as count
        from range(0, 10) t(i) cross join e left join c on c.bin = i + 1""",
    cte=False,
)
def histogram_bins(spark, d):
    return finish(binning.histogram(table(spark, d, "events"), "value", 10))
