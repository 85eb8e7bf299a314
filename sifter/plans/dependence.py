"""Bound queries: correlations, relation report, mutual information (H1-H6, K2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sifter.operators import dependence, profile
from sifter.plans.common import R, finish, probs_sql, sale, sql_bin, with_sale

QUERIES: dict = {}
ORACLE: dict = {}


def query(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_sale(sql)
        return fn

    return deco


# columns of the correlation queries; area, n_items and garage_yr hold nulls, so
# every pair has rows of its own
NUM_COLS = ["acctbal", "yr_built", "yr_sold", "n_items", "area", "price"]


def _pairs_sql(cols, table, r="corr"):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"select '{a}' as col_i, '{b}' as col_j, {R(f'{r}({a}, {b})', 'r')} from {table}")
            parts.append(f"select '{b}' as col_i, '{a}' as col_j, {R(f'{r}({a}, {b})', 'r')} from {table}")
        parts.append(f"select '{a}' as col_i, '{a}' as col_j, cast(1.0 as double) as r")
    return " union all ".join(parts)


PEARSON_COLS = ["area", "n_items", "acctbal", "price", "yr_built"]


@query("pearson_matrix", _pairs_sql(PEARSON_COLS, "sale"))
def pearson_matrix(spark, d):
    return finish(dependence.pearson_long(sale(spark, d), PEARSON_COLS))


#: Derived columns, with nulls of their own: b{k} of every number that is in class k of sale_id.
WIDE = 8


WIDE_SQL = {
    f"{c}_{k}": f"case when sale_id % {k + 2} <> 0 then cast({c} as double) + (sale_id % {k + 3}) * {100 * (k + 1)} end"
    for c in PEARSON_COLS
    for k in range(WIDE)
}


@query(
    "pearson_wide_matrix",
    f"with wide as (select {', '.join(f'{x} as {c}' for c, x in WIDE_SQL.items())} from sale) {_pairs_sql(list(WIDE_SQL), 'wide')}",
)
def pearson_wide_matrix(spark, d):
    """H1 over forty columns, each with nulls of its own, by blocks."""
    wide = sale(spark, d).select(*[F.expr(x).alias(c) for c, x in WIDE_SQL.items()])
    return finish(dependence.pearson_wide(wide, list(WIDE_SQL), block=16))


SPEARMAN_COLS = ["acctbal", "price", "yr_built", "area", "garage_yr"]  # the last two hold nulls


def _rho_sql(a, b, src):
    """Spearman over the rows of ``src`` where both columns are present."""
    rank = "rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0"
    return (f"(select corr(x, y) from (select {rank.format(c=a)} as x, {rank.format(c=b)} as y from {src} "
            f"where {a} is not null and {b} is not null))")


def _spearman_sql(cols, src="sale"):
    parts = [f"select '{a}' as col_i, '{a}' as col_j, cast(1.0 as double) as r" for a in cols]
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            rho = R(_rho_sql(a, b, src), "r")
            parts += [f"select '{a}', '{b}', {rho}", f"select '{b}', '{a}', {rho}"]
    return " union all ".join(parts)


@query("spearman_matrix", _spearman_sql(SPEARMAN_COLS))
def spearman_matrix(spark, d):
    return finish(dependence.spearman_long(sale(spark, d).select(*SPEARMAN_COLS), SPEARMAN_COLS))


FEATURES = ["acctbal", "yr_built", "yr_sold", "n_items", "area"]


def _target_corr_sql():
    parts = " union all ".join(
        f"select '{c}' as feature, corr({c}, price) as pearson, {_rho_sql(c, 'price', 'sale')} as spearman from sale"
        for c in FEATURES
    )
    parts += " union all select 'price', 1.0, 1.0"
    return f"with tc as ({parts})"


@query(
    "corr_top_n",
    f"""{_target_corr_sql()}
        select feature, {R('pearson', 'pearson')}, {R('spearman', 'spearman')} from tc
        order by abs(pearson) desc, feature limit 4""",
)
def corr_top_n(spark, d):
    tc = dependence.target_correlations(sale(spark, d).select(*NUM_COLS), "price", FEATURES)
    return finish(dependence.top_by_abs(tc, "pearson", 4))


@query(
    "corr_top_bottom",
    f"""{_target_corr_sql()}
        select * from (select feature, {R('pearson', 'pearson')}, {R('spearman', 'spearman')}, 'top' as "end"
                       from tc where feature <> 'price' order by pearson desc, feature limit 2)
        union all
        select * from (select feature, {R('pearson', 'pearson')}, {R('spearman', 'spearman')}, 'bottom' as "end"
                       from tc where feature <> 'price' order by pearson asc, feature limit 2)""",
)
def corr_top_bottom(spark, d):
    tc = dependence.target_correlations(sale(spark, d).select(*NUM_COLS), "price", FEATURES).where(
        F.col("feature") != "price"
    )
    return finish(profile.top_and_bottom(tc, "pearson", 2, tie=["feature"]))


@query(
    "corr_heatmap_cells",
    f"""{_target_corr_sql()}, top as (select feature from tc order by abs(pearson) desc, feature limit 4),
        cells as ({_pairs_sql(NUM_COLS, 'sale')})
        select * from cells where col_i in (select feature from top) and col_j in (select feature from top)""",
)
def corr_heatmap_cells(spark, d):
    """H4: Pearson sub-matrix of the top features (long form)."""
    f = sale(spark, d).select(*NUM_COLS)
    row = dependence.pearson_long(f, NUM_COLS).where(F.col("col_j") == "price")
    top = [r["feature"] for r in dependence.top_by_abs(row.withColumnRenamed("col_i", "feature"), "r", 4).collect()]
    return finish(dependence.pearson_long(f, top))


# ---- H5 relation report ----------------------------------------------------------------
REL_NUM, REL_TEXT = ["area", "acctbal", "n_items"], ["zone", "cond"]
_STATS = (f"{R('avg(price)', 'mean')}, {R('quantile_cont(price, 0.5)', 'median')}, {R('stddev_samp(price)', 'std')}, "
          "count(price) as count")


def _relation_sql() -> str:
    parts = []
    for c in REL_NUM:
        parts.append(f"""select '{c}' as feature, cast(bin as varchar) as segment,
            {R(f'(select corr({c}, price) from sale)', 'pearson')}, {R(_rho_sql(c, 'price', 'sale'), 'spearman')}, {_STATS},
            cast(row_number() over (order by bin) as int) as rank
            from (select s.price, {sql_bin(f's.{c}', 'e.e')} as bin from sale s,
                  (select list_sort(list_distinct(quantile_cont({c}, {probs_sql(4)}))) as e from sale) e
                  where s.{c} is not null) group by bin""")
    for c in REL_TEXT:
        parts.append(f"""select '{c}', {c}, cast(null as double), cast(null as double), {_STATS},
            cast(row_number() over (order by avg(price) desc, {c}) as int) as rank
            from sale where {c} is not null group by {c}""")
    return " union all ".join(parts)


@query("relation_report", _relation_sql())
def relation_report(spark, d):
    """H5: every number with r, rho and target statistics by quartile; every text
    column by category, highest mean first."""
    return finish(dependence.relation_report(sale(spark, d), "price", REL_NUM, REL_TEXT))


# ---- H6 mutual information ---------------------------------------------------------------
MI_NUM = ["area", "acctbal", "yr_built", "n_items", "is_urgent", "n_small"]  # a 0/1 flag and a 0-3 count among them
MI_TEXT = ["zone", "qual", "cond", "urgent_text"]


def _with_flags(s):
    """``sale`` with a flag, as number and as text, and a small count."""
    urgent = F.col("qual") == "1-URGENT"
    return s.select(
        "*", F.when(F.col("qual").isNotNull(), urgent.cast("int")).alias("is_urgent"),
        F.when(urgent, "yes").otherwise("no").alias("urgent_text"),
        F.least(F.pmod(F.col("n_items"), F.lit(5)), F.lit(3)).alias("n_small"),
    )


def _mi_sql():
    fill = ", ".join(f"coalesce(cast({c} as double), (select quantile_cont({c}, 0.5) from t)) as {c}" for c in MI_NUM)
    txt = ", ".join(f"coalesce({c}, 'NA') as {c}" for c in MI_TEXT)
    ranked = ", ".join(
        f"cast(floor(10 * (rank() over (order by {c}) - 1) / count(*) over ()) as bigint) as {c}" for c in MI_NUM + ["price"]
    )
    xs = " union all ".join(f"select '{c}' as feature, cast({c} as varchar) as x, price as y from b" for c in MI_NUM + MI_TEXT)
    return f"""with t as (select *, case when qual is not null then cast(qual = '1-URGENT' as int) end as is_urgent,
               case when qual = '1-URGENT' then 'yes' else 'no' end as urgent_text,
               least(n_items % 5, 3) as n_small from sale where price is not null),
        f as (select price, {fill}, {txt} from t),
        b as (select {ranked}, {', '.join(MI_TEXT)} from f),
        l as ({xs}),
        j as (select feature, x, y, count(*) as nxy from l group by all),
        jm as (select feature, nxy, sum(nxy) over (partition by feature) as n,
                      sum(nxy) over (partition by feature, x) as nx, sum(nxy) over (partition by feature, y) as ny
               from j)
        select feature, {R('sum(cast(nxy as double) / n * ln(cast(nxy as double) * n / (cast(nx as double) * ny)))', 'mi')}
        from jm group by feature"""


@query("mutual_info_rank", _mi_sql())
def mutual_info_rank(spark, d):
    return finish(dependence.mutual_information(_with_flags(sale(spark, d)), "price", MI_NUM, MI_TEXT, bins=10))
