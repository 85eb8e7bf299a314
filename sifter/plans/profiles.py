"""Bound queries: group statistics, tiers, profiles, error tables, chart data."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sifter.operators import binning, impute, models, profile
from sifter.plans.common import R, finish, own, probs_sql, sale, sql_bin, sql_equal_width
from sifter.sources.tables import events, with_sale

QUERIES: dict = {}
ORACLE: dict = {}


def query(name, sql=None, cte=True):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_sale(sql) if cte else sql
        return fn

    return deco


# ---- F8 tiers and G4 group statistics ---------------------------------------
TIERS_SQL = f"""
means as (select nbhd, avg(price) as m from sale where nbhd is not null group by nbhd),
te as (select quantile_cont(m, {probs_sql(5)}) as e from means),
tiers as (select nbhd, 'NB_Level_' || cast({sql_bin('m', 'e')} as varchar) as tier from means, te)
"""


@query(
    "price_tier",
    f""", {TIERS_SQL.strip()}
        select s.sale_id, s.nbhd, coalesce(t.tier, 'NB_Level_3') as tier
        from sale s left join tiers t on s.nbhd = t.nbhd""",
)
def price_tier(spark, d):
    s = own(sale(spark, d).select("sale_id", "nbhd", "price", "area"))
    tiers = binning.fit_group_tiers(s, "nbhd", "price", bins=5, out_col="tier")
    return tiers.transform(s).select("sale_id", "nbhd", "tier")


FOLDS = 5
FOLD_SQL = f"cast('0x' || substr(md5(cast(sale_id as varchar) || ':42'), 1, 8) as bigint) % {FOLDS}"


@query(
    "price_tier_by_fold",
    f""", lots as (select sale_id, nbhd, price, {FOLD_SQL} as fold from sale),
        out_means as (select f.fold, l.nbhd, avg(l.price) as m from lots l, range(0, {FOLDS}) f(fold)
                      where l.fold <> f.fold and l.nbhd is not null group by all),
        te as (select fold, quantile_cont(m, {probs_sql(5)}) as e from out_means group by fold),
        tiers as (select fold, nbhd, 'NB_Level_' || cast({sql_bin('m', 'e')} as varchar) as tier
                  from out_means join te using (fold))
        select l.sale_id, l.nbhd, coalesce(t.tier, 'NB_Level_3') as tier
        from lots l left join tiers t on l.nbhd = t.nbhd and l.fold = t.fold""",
)
def price_tier_by_fold(spark, d):
    """F8 as a cross-validation needs it: no row's tier uses its own fold."""
    s = sale(spark, d).select("sale_id", "nbhd", "price")
    fold = models.fold_of("sale_id", FOLDS)
    return binning.fold_group_tiers(s, "nbhd", "price", fold, FOLDS, out_col="tier").select("sale_id", "nbhd", "tier")


@query(
    "group_target_stats",
    f"""select nbhd, {R('avg(price)', 'mean')}, {R('quantile_cont(price, 0.5)', 'median')},
              {R('stddev_samp(price)', 'std')}, count(price) as count
       from sale group by nbhd
       union all
       select cond, {R('avg(price)', 'mean')}, {R('quantile_cont(price, 0.5)', 'median')},
              {R('stddev_samp(price)', 'std')}, count(price) from sale where cond is not null group by cond""",
)
def group_target_stats(spark, d):
    """G4 by area and by a column with nulls, whose rows are in no group."""
    s = own(sale(spark, d).select("nbhd", "cond", "price"))
    by_cond = profile.group_stats(s, "cond", "price").withColumnRenamed("cond", "nbhd")
    return finish(profile.group_stats(s, "nbhd", "price").unionByName(by_cond))


@query(
    "tier_target_stats",
    f""", {TIERS_SQL.strip()},
        filled as (select s.sale_id, s.nbhd, s.price,
                          coalesce(s.area, (select quantile_cont(area, 0.5) from sale x where x.nbhd = s.nbhd)) as area
                   from sale s),
        tiered as (select f.*, coalesce(t.tier, 'NB_Level_3') as tier from filled f left join tiers t on f.nbhd = t.nbhd)
        select tier, {R('avg(price)', 'mean')}, {R('quantile_cont(price, 0.5)', 'median')},
               {R('stddev_samp(price)', 'std')}, count(price) as count, {R('avg(area)', 'mean_area')}
        from tiered group by tier""",
)
def tier_target_stats(spark, d):
    """Flagship slice: group-median imputation -> price tiers -> stats per tier.
    The tier fit reads only (nbhd, price), which imputation leaves unchanged,
    so it is fitted on the prepared table directly."""
    s = own(sale(spark, d).select("sale_id", "nbhd", "price", "area"))
    tiers = binning.fit_group_tiers(s, "nbhd", "price", bins=5, out_col="tier")
    tiered = tiers.transform(impute.group_median_fill(s, "area", ["nbhd"]))
    stats = profile.group_stats(tiered, "tier", "price", extra={"mean_area": F.avg("area")})
    return finish(stats)


@query(
    "group_mean_sorted",
    f"select cond, {R('avg(price)', 'mean')} from sale where cond is not null group by cond",
)
def group_mean_sorted(spark, d):
    """G8, by a column with nulls."""
    return finish(profile.group_mean(sale(spark, d), "cond", "price"))


# ---- G5 quartile statistics ---------------------------------------------------
@query(
    "quartile_target_stats",
    f"""with e as (select list_sort(list_distinct(quantile_cont(area, {probs_sql(4)}))) as e from sale),
        b as (select s.price, {sql_bin('s.area', 'e.e')} as bin, e.e from sale s, e where s.area is not null)
        select cast(bin as int) as area_bin, e[bin] as area_lo, e[bin + 1] as area_hi,
               {R('avg(price)', 'mean')}, {R('quantile_cont(price, 0.5)', 'median')},
               {R('stddev_samp(price)', 'std')}, count(price) as count
        from b group by bin, e""",
)
def quartile_target_stats(spark, d):
    s = binning.qcut_merged(own(sale(spark, d).select("area", "price")), "area", 4, out_col="area_bin").where(F.col("area").isNotNull())
    return finish(profile.group_stats(s, ["area_bin", "area_bin_lo", "area_bin_hi"], "price").withColumnRenamed(
        "area_bin_lo", "area_lo").withColumnRenamed("area_bin_hi", "area_hi"))


# ---- G1/G2/V6 descriptive statistics -------------------------------------------
DESC_COLS = ["area", "price", "acctbal", "n_items"]


def _describe_sql(cols):
    parts = [
        f"""select '{c}' as name, count({c}) as count, {R(f'avg({c})', 'mean')}, {R(f'stddev_samp({c})', 'std')},
                   {R(f'min({c})', 'min')}, {R(f'quantile_cont({c}, 0.25)', 'p25')},
                   {R(f'quantile_cont({c}, 0.5)', 'p50')}, {R(f'quantile_cont({c}, 0.75)', 'p75')},
                   {R(f'max({c})', 'max')} from sale"""
        for c in cols
    ]
    return " union all ".join(parts)


@query("describe_numeric", _describe_sql(DESC_COLS))
def describe_numeric(spark, d):
    return finish(profile.describe(own(sale(spark, d).select(*DESC_COLS)), DESC_COLS))


def _moments_sql(cols):
    return " union all ".join(
        f"select '{c}' as name, {R(f'skewness({c})', 'skew')}, {R(f'kurtosis({c})', 'kurt')} from sale" for c in cols
    )


@query("skew_kurtosis", _moments_sql(DESC_COLS))
def skew_kurtosis(spark, d):
    return finish(profile.moments(sale(spark, d), DESC_COLS))


def _distribution_sql(cols):
    return f"""select * from ({_describe_sql(cols)}) a join ({_moments_sql(cols)}) b using (name)"""


@query("distribution_report", _distribution_sql(["price", "acctbal", "yr_built"]))
def distribution_report(spark, d):
    return finish(profile.distribution_report(own(sale(spark, d).select("price", "acctbal", "yr_built")), ["price", "acctbal", "yr_built"]))


def _bins_sql(cols):
    parts = [
        f"""select '{c}' as name, g.b as bin, e.e[g.b] as lo, e.e[g.b + 1] as hi,
                   (select count(*) from sale s where {sql_bin(f's.{c}', 'e.e')} = g.b) as count
            from (select {sql_equal_width(f'min(cast({c} as double))', f'max(cast({c} as double))', 10)} as e from sale) e,
                 (select cast(unnest(range(1, 11)) as int) as b) g"""
        for c in cols
    ]
    return f"select name, bin, {R('lo', 'lo')}, {R('hi', 'hi')}, count from ({' union all '.join(parts)})"


@query("distribution_bins", _bins_sql(["price", "acctbal", "yr_built"]))
def distribution_bins(spark, d):
    """V6: the ten-bin table of every number."""
    return finish(profile.distribution_bins(sale(spark, d), ["price", "acctbal", "yr_built"]))


def _categories_sql(cols):
    return " union all ".join(
        f"select '{c}' as name, {c} as value, count(*) as count, "
        f"{R('cast(count(*) as double) * 100.0 / sum(count(*)) over ()', 'percent')} from sale where {c} is not null group by {c}"
        for c in cols
    )


@query("distribution_categories", _categories_sql(["zone", "qual", "cond"]))
def distribution_categories(spark, d):
    """V6: counts and shares of every text column."""
    return finish(profile.distribution_categories(sale(spark, d), ["zone", "qual", "cond"]))


@query(
    "value_counts_share",
    f"""select zone, count(*) as count, {R('cast(count(*) as double) * 100.0 / sum(count(*)) over ()', 'percent')}
        from sale where zone is not null group by zone""",
)
def value_counts_share(spark, d):
    return finish(profile.value_counts(sale(spark, d), "zone"))


# ---- G9 group modes --------------------------------------------------------------
def _mode_sql(c, g):
    return f"""select {g}, {c} from (select {g}, {c}, row_number() over (partition by {g} order by count(*) desc, {c}) as rn
                from sale where {c} is not null group by {g}, {c}) where rn = 1"""


@query(
    "group_mode",
    f"select * from ({_mode_sql('qual', 'nbhd')}) a full join ({_mode_sql('cond', 'nbhd')}) b using (nbhd)",
)
def group_mode(spark, d):
    return profile.group_modes(sale(spark, d), ["nbhd"], ["qual", "cond"])


@query("distinct_values", "select distinct qual from sale")
def distinct_values(spark, d):
    """G10."""
    return sale(spark, d).select("qual").distinct()


# ---- G6/G7/G11/G12 error analysis with a deterministic predictor ----------------------
PRED_SQL = "price * (1 + ((sale_id % 21) - 10) / 100.0e0)"


def _scored(spark, d):
    s = sale(spark, d)
    pred = F.col("price") * (1 + (F.pmod(F.col("sale_id"), F.lit(21)) - 10) / 100.0)
    return s.select(
        "sale_id", "price", F.log1p("price").alias("y_log"), F.log1p(pred).alias("pred_log")
    )


SCORED_SQL = f"select sale_id, price, ln(1 + price) as y_log, ln(1 + {PRED_SQL}) as pred_log from sale"

DECILES_SQL = f"""
scored as ({SCORED_SQL}),
de as (select quantile_cont(price, {probs_sql(10)}) as e from scored),
seg as (select s.*, 'D' || cast({sql_bin('s.price', 'de.e')} as varchar) as decile,
               abs(y_log - pred_log) as err, abs((exp(y_log) - 1) - (exp(pred_log) - 1)) as err_orig
        from scored s, de),
tab as (select decile, avg(err) as mean_log_err, quantile_cont(err, 0.5) as median_log_err, max(err) as max_log_err,
               count(y_log) as n, avg(err_orig) as mae_original from seg group by decile)
"""


@query(
    "error_by_decile",
    f"""with {DECILES_SQL.strip()}
        select decile, {R('mean_log_err', 'mean_log_err')}, {R('median_log_err', 'median_log_err')},
               {R('max_log_err', 'max_log_err')}, n, {R('mae_original', 'mae_original')} from tab""",
    cte=True,
)
def error_by_decile(spark, d):
    seg = binning.decile_labels(own(_scored(spark, d)), "price", "decile")
    return finish(profile.error_by_segment(seg, "y_log", "pred_log", "decile"))


@query(
    "worst_decile",
    f"""with {DECILES_SQL.strip()}
        select decile from tab order by mean_log_err desc, decile limit 1""",
    cte=True,
)
def worst_decile(spark, d):
    seg = binning.decile_labels(own(_scored(spark, d)), "price", "decile")
    tab = profile.error_by_segment(seg, "y_log", "pred_log", "decile")
    return profile.argmax_label(tab, "decile", "mean_log_err")


@query(
    "regression_metrics",
    f"""with s as ({SCORED_SQL})
        select {R('avg((y_log - pred_log) * (y_log - pred_log))', 'mse_log')},
               {R('sqrt(avg((y_log - pred_log) * (y_log - pred_log)))', 'rmse_log')},
               {R('avg(abs(y_log - pred_log))', 'mae_log')},
               {R('1 - sum((y_log - pred_log) * (y_log - pred_log)) / (count(y_log) * var_pop(y_log))', 'r2_log')},
               {R('sqrt(avg(((exp(y_log) - 1) - (exp(pred_log) - 1)) * ((exp(y_log) - 1) - (exp(pred_log) - 1))))', 'rmse_orig', 2)},
               {R('avg(abs((exp(y_log) - 1) - (exp(pred_log) - 1)))', 'mae_orig', 4)}
        from s""",
    cte=True,
)
def regression_metrics(spark, d):
    m = profile.regression_metrics(_scored(spark, d), "y_log", "pred_log")
    return finish(m).select(
        "mse_log", "rmse_log", "mae_log", "r2_log",
        F.round("rmse_orig", 2).alias("rmse_orig"), F.round("mae_orig", 4).alias("mae_orig"),
    )


@query(
    "fold_metric_summary",
    f"""with s as ({SCORED_SQL}),
        f as (select sale_id % 10 as fold,
                     1 - sum((y_log - pred_log) * (y_log - pred_log)) / (count(y_log) * var_pop(y_log)) as r2,
                     sqrt(avg((y_log - pred_log) * (y_log - pred_log))) as rmse,
                     avg(abs(y_log - pred_log)) as mae
              from s group by sale_id % 10)
        select {R('avg(r2)', 'r2_mean')}, {R('stddev_pop(r2)', 'r2_std')}, {R('avg(rmse)', 'rmse_mean')},
               {R('stddev_pop(rmse)', 'rmse_std')}, {R('avg(mae)', 'mae_mean')}, {R('stddev_pop(mae)', 'mae_std')}
        from f""",
    cte=True,
)
def fold_metric_summary(spark, d):
    """G12 over folds given by a key rule (``sale_id mod 10``, reproducible in SQL)."""
    s = _scored(spark, d).withColumn("fold", F.pmod(F.col("sale_id"), F.lit(10)))
    r = F.col("y_log") - F.col("pred_log")
    per = s.groupBy("fold").agg(
        (1 - F.try_divide(F.sum(r * r), F.count("y_log") * F.var_pop("y_log"))).alias("r2"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(F.abs(r)).alias("mae"),
    )
    return finish(profile.fold_summary(per, ["r2", "rmse", "mae"]))


@query(
    "residual_points",
    f"""select sale_id, {R('y_log', 'actual')}, {R('pred_log', 'predicted')}, {R('y_log - pred_log', 'residual')}
        from ({SCORED_SQL})""",
)
def residual_points(spark, d):
    """V5: every (actual, predicted, residual) point (no sampling)."""
    s = _scored(spark, d)
    return finish(s.select(
        "sale_id", F.col("y_log").alias("actual"), F.col("pred_log").alias("predicted"),
        (F.col("y_log") - F.col("pred_log")).alias("residual"),
    ))


# ---- V1/V2/V4 chart data on the skewed ``events.value`` -----------------------------
@query(
    "box_stats",
    f"""with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as q2,
                          quantile_cont(value, 0.75) as q3 from events where value is not null),
        f as (select q1, q2, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from q)
        select {R('q1', 'q1')}, {R('q2', 'median')}, {R('q3', 'q3')}, {R('iqr', 'iqr')},
               {R('lo', 'lower_fence')}, {R('hi', 'upper_fence')},
               {R('min(case when value >= lo and value <= hi then value end)', 'whisker_low')},
               {R('max(case when value >= lo and value <= hi then value end)', 'whisker_high')},
               cast(sum(case when value >= lo and value <= hi then 0 else 1 end) as bigint) as n_outliers
        from events, f where value is not null group by q1, q2, q3, iqr, lo, hi""",
    cte=True,
)
def box_stats(spark, d):
    return finish(profile.box_stats(events(spark, d), "value"))


@query(
    "box_stats_by_group",
    f"""with q as (select zone, quantile_cont(price, 0.25) as q1, quantile_cont(price, 0.5) as q2,
                          quantile_cont(price, 0.75) as q3 from sale where price is not null group by zone),
        f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from q)
        select f.zone, {R('q1', 'q1')}, {R('q2', 'median')}, {R('q3', 'q3')}, {R('iqr', 'iqr')},
               {R('lo', 'lower_fence')}, {R('hi', 'upper_fence')},
               {R('min(case when price >= lo and price <= hi then price end)', 'whisker_low')},
               {R('max(case when price >= lo and price <= hi then price end)', 'whisker_high')},
               cast(sum(case when price >= lo and price <= hi then 0 else 1 end) as bigint) as n_outliers
        from sale join f on sale.zone is not distinct from f.zone
        where price is not null group by f.zone, q1, q2, q3, iqr, lo, hi""",
)
def box_stats_by_group(spark, d):
    """V2 by category: the target's box for each zone."""
    return finish(profile.box_stats(sale(spark, d), "price", by="zone"))


REPLICATES, BAND_POINTS = 50, 10


def _weight_sql() -> str:
    """Poisson(1) weights: the number of cumulative chances that a hash of key and replicate reaches."""
    u = "cast(cast('0x' || substr(md5(cast(sale_id as varchar) || ':' || cast(r as varchar) || ':42'), 1, 8) as bigint) as double) / 4294967296.0"
    below, term, cuts = 0.0, math.exp(-1), []
    for k in range(profile.POISSON):
        below, term = below + term, term / (k + 1)
        cuts.append(repr(below))
    return f"len(list_filter([{', '.join(cuts)}], lambda c: c <= {u}))"


@query(
    "fitted_band",
    f"""with k as (select sale_id, cast(area as double) as x, cast(price as double) as y from sale where area is not null and price is not null),
        span as (select min(x) as lo, (max(x) - min(x)) / {BAND_POINTS - 1} as step from k),
        w as (select r, x - lo as v, y, case when r = 0 then 1 else {_weight_sql()} end as w
              from k, span, range(0, {REPLICATES + 1}) t(r)),
        s as (select r, sum(w) as n, sum(w * v) as sx, sum(w * y) as sy, sum(w * v * v) as sxx, sum(w * v * y) as sxy
              from w group by r),
        l as (select r, (n * sxy - sx * sy) / (n * sxx - sx * sx) as slope, n, sx, sy from s where n * sxx - sx * sx <> 0),
        g as (select r, i + 1 as point, lo + i * step as x, (sy - slope * sx) / n + slope * i * step as value
              from l, span, range(0, {BAND_POINTS}) t(i))
        select cast(point as int) as point, {R('max(x)', 'x')}, {R('max(case when r = 0 then value end)', 'fit')},
               {R('quantile_cont(case when r > 0 then value end, 0.025)', 'low')},
               {R('quantile_cont(case when r > 0 then value end, 0.975)', 'high')}
        from g group by point""",
)
def fitted_band(spark, d):
    """V4: the fitted line with its bootstrap band."""
    s = own(sale(spark, d).select("sale_id", "area", "price"))
    return finish(profile.fitted_band(s, "sale_id", "area", "price", BAND_POINTS, REPLICATES))


DENSITY_POINTS = 50


@query(
    "density_grid",
    f"""with st as (select count(value) as n, stddev_samp(value) as sd, min(value) as mn, max(value) as mx
                    from events),
        g as (select i, mn + i * ((mx - mn) / {DENSITY_POINTS - 1}) as x, sd * pow(n, -0.2) as h, n
              from st, range(0, {DENSITY_POINTS}) t(i))
        select cast(i + 1 as int) as point, {R('x', 'x')},
               {R('sum(exp(-0.5 * pow((x - value) / h, 2))) * (1.0 / (n * h * sqrt(2 * pi())))', 'density')}
        from g, events where value is not null group by i, x, h, n""",
    cte=True,
)
def density_grid(spark, d):
    return finish(profile.density_grid(events(spark, d), "value", DENSITY_POINTS))


@query(
    "fitted_line",
    f"select {R('regr_slope(price, area)', 'slope')}, {R('regr_intercept(price, area)', 'intercept')} from sale",
)
def fitted_line(spark, d):
    return finish(profile.fitted_line(sale(spark, d), "area", "price"))
