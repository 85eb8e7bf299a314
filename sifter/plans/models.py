"""Bound queries: outliers, clustering, boosted trees, validation, scoring, ridge.

Splits go by md5 of the key, which DuckDB shares, and ridge by its normal
equations; the fits themselves are library-specific, so their queries have no
oracle SQL and tests check their properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from sifter.operators import impute, models, outliers, profile
from sifter.operators.columns import align_columns
from sifter.plans.common import R, finish, own, sale, with_sale
from sifter.session import scratch_path
from sifter.sources import files

QUERIES: dict = {}
ORACLE: dict = {}

NUMERIC = ["area", "n_items", "garage_yr", "acctbal", "yr_built", "yr_sold"]
CATEGORICAL = ["nbhd", "zone", "qual", "cond", "garage_type"]
#: The queries grow fewer and larger steps than the operators' defaults (2,000 rounds at 0.01).
GBT = dict(rounds=20, rate=0.1, bins=64, seed=42)
#: Early stopping: many more rounds are allowed than are of use, so that the rule acts.
STOPPING = dict(GBT, rounds=200, rate=0.5, patience=8)


def query(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_sale(sql)
        return fn

    return deco


ALL = ["sale_id", "price", *NUMERIC, *CATEGORICAL]


def cleaned(spark, d, columns=ALL):
    """The reference's cleaning order on ``sale``: C1 -> C3 -> C4 -> C2."""
    s = impute.fill_text(own(sale(spark, d).select(*columns)), ["garage_type", "cond"])
    s = impute.conditional_fill(s, "garage_yr", "garage_type", "NA", "yr_built")
    s = impute.group_median_fill(s, "area", ["nbhd"])
    return impute.fill_number(s, ["n_items", "area"], 0)


FOREST_COLS = ["area", "acctbal", "n_items", "price"]


@query("isolation_forest")
def isolation_forest(spark, d):
    s = own(sale(spark, d).select("sale_id", *FOREST_COLS))
    forest = outliers.IsolationForest(FOREST_COLS, trees=100, sample_size=256, contamination=0.01, seed=42)
    forest.fit(s, "sale_id")
    return finish(forest.outliers(s, "sale_id"))


@query("outlier_removal")
def outlier_removal(spark, d):
    """Domain rule (null comparisons false) union forest -> anti-join."""
    s = own(sale(spark, d).select("sale_id", "nbhd", *FOREST_COLS))
    forest = outliers.IsolationForest(FOREST_COLS, contamination=0.01, seed=42).fit(s, "sale_id")
    rule = (F.col("area") > 150) | (F.col("acctbal") > 9000)
    return outliers.remove_outliers(s, "sale_id", rule, forest).select("sale_id", "nbhd", "price")


@query("kmeans_segments")
def kmeans_segments(spark, d):
    cols = ["area", "n_items", "acctbal", "yr_built", "garage_yr"]
    s = cleaned(spark, d, ["sale_id", "nbhd", "garage_type", "cond", *cols])
    return models.kmeans_segments(s, "sale_id", cols, k=5)


def _split(spark, d):
    s = cleaned(spark, d)
    return models.holdout(s, "sale_id", 0.1)


def lot_sql(seed: int, n: int) -> str:
    return f"cast(cast('0x' || substr(md5(cast(sale_id as varchar) || ':{seed}'), 1, 8) as bigint) % {n} as int)"


@query(
    "fold_table",
    f"select fold, count(*) as n, sum(sale_id) as key_sum from (select sale_id, {lot_sql(42, 10)} as fold from sale) group by fold",
)
def fold_table(spark, d):
    """The ten folds, each key in one."""
    s = sale(spark, d).select("sale_id", models.fold_of("sale_id", 10).alias("fold"))
    return s.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("sale_id").alias("key_sum"))


@query(
    "holdout_split",
    f"select case when {lot_sql(43, 1000)} >= 100 then 'train' else 'test' end as split, count(*) as n from sale group by 1",
)
def holdout_split(spark, d):
    train, test = models.holdout(sale(spark, d), "sale_id", 0.1)
    return train.select(F.lit("train").alias("split"), "sale_id").unionByName(
        test.select(F.lit("test").alias("split"), "sale_id")
    ).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("gbt_fit_metrics")
def gbt_fit_metrics(spark, d):
    """N4 + N7: fit on the training split with a 10 % validation indicator, which
    ends the fit, metrics on the hold-out in log and original scale."""
    train, test = _split(spark, d)
    train = train.withColumn("_val", models.fold_of("sale_id", 10, 7) == 0)
    tm = models.fit_trees(train, "sale_id", "price", NUMERIC, CATEGORICAL, validation_col="_val", **STOPPING)
    pred = tm.predict(test, "sale_id").join(test.select("sale_id", "price"), "sale_id")
    pred = pred.withColumn("y_log", F.log1p("price"))
    sc = models.regression_scores(pred, "y_log", "pred_log")
    mae_orig = pred.agg(F.avg(F.abs(F.col("price") - F.expm1("pred_log")))).first()[0]
    rows = [(sc["r2"], sc["rmse"], sc["mae"], mae_orig, tm.rounds_tried, tm.rounds_kept)]
    schema = "r2 double, rmse_log double, mae_log double, mae_orig double, rounds_tried int, best_round int"
    return spark.createDataFrame(rows, schema)


@query("cross_validate")
def cross_validate(spark, d):
    """N5 + G12: 10-fold CV of the log target; per-fold rows plus mean/std, which stand beside each."""
    s = cleaned(spark, d)
    per = own(models.cross_validate(s, "sale_id", "price", NUMERIC, CATEGORICAL, folds=10, **GBT), "folds")
    return finish(per.crossJoin(F.broadcast(profile.fold_summary(per, ["r2", "rmse", "mae"]))))


@query("feature_importance")
def feature_importance(spark, d):
    train, _ = _split(spark, d)
    tm = models.fit_trees(train, "sale_id", "price", NUMERIC, CATEGORICAL, **GBT)
    return finish(tm.importances(spark))


@query("batch_score")
def batch_score(spark, d):
    """Fit on the train part, align the test part to the training columns,
    predict, expm1, clamp, write the submission CSV, return it."""
    s = cleaned(spark, d)
    train = s.where(F.col("yr_sold") <= 1998)
    test = s.where(F.col("yr_sold") > 1998).drop("price")
    tm = models.fit_trees(train, "sale_id", "price", NUMERIC, CATEGORICAL, **GBT)
    aligned = align_columns(test, ["sale_id", *NUMERIC, *CATEGORICAL], category_cols=CATEGORICAL)
    sub = tm.predict(aligned, "sale_id").select(F.col("sale_id").alias("Id"), F.col("prediction").alias("SalePrice"))
    path = scratch_path(spark, "submission")
    files.write_csv(sub, path)
    return files.read_csv(spark, path, "Id bigint, SalePrice double")


ALPHA = 10.0


def _ridge_sql() -> str:
    """Normal equations of the standardized columns, solved by elimination: a step a column."""
    p = len(NUMERIC)
    stats = ", ".join(f"avg({c}) as m{i}, stddev_pop({c}) as s{i}" for i, c in enumerate(NUMERIC))
    z = ", ".join(f"({c} - m{i}) / (case when s{i} = 0 then 1 else s{i} end) as z{i}" for i, c in enumerate(NUMERIC))
    cells = [f"sum(z{i} * z{j}) + {ALPHA if i == j else 0.0} as a{i}_{j}" for i in range(p) for j in range(p)]
    cells += [f"sum(z{i} * (y - ym)) as a{i}_{p}" for i in range(p)]
    steps = [f"e0 as (select {', '.join(cells)}, max(ym) as ym from z)"]
    for k in range(p):
        rest = [
            f"a{i}_{j} / a{k}_{k} as a{i}_{j}" if i == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} as a{i}_{j}"
            for i in range(p) for j in range(p + 1)
        ]
        steps.append(f"e{k + 1} as (select {', '.join(rest)}, ym from e{k})")
    out = " union all ".join(
        [f"select '{c}' as feature, {R(f'a{i}_{p}', 'coef')} from e{p}" for i, c in enumerate(NUMERIC)]
        + [f"select '(intercept)', {R('ym', 'coef')} from e{p}"]
    )
    return f"""with med as (select nbhd, quantile_cont(area, 0.5) as am from sale group by nbhd),
        c as (select coalesce(cast(s.area as double), am, 0) as area, coalesce(cast(n_items as double), 0) as n_items,
                     cast(case when garage_type is null then coalesce(garage_yr, 0) else coalesce(garage_yr, yr_built) end as double) as garage_yr,
                     cast(acctbal as double) as acctbal, cast(yr_built as double) as yr_built, cast(yr_sold as double) as yr_sold,
                     ln(1 + price) as y
              from sale s left join med on s.nbhd = med.nbhd),
        st as (select {stats}, avg(y) as ym from c),
        z as materialized (select y, ym, {z} from c, st),
        {', '.join(steps)} {out}"""


@query("ridge_fit", _ridge_sql())
def ridge_fit(spark, d):
    s = cleaned(spark, d, ["sale_id", "price", "nbhd", "garage_type", "cond", *NUMERIC])
    return finish(models.ridge_fit(s.withColumn("y", F.log1p("price")), "y", NUMERIC, alpha=ALPHA))
