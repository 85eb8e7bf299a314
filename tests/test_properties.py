"""Properties of the operators without an SQL oracle (SURVEY §5 (c), (d))."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from sifter.operators import models, outliers, patterns
from sifter.plans import mining
from sifter.plans import models as model_plans
from sifter.sources.tables import sale


@pytest.fixture(scope="module")
def tx(spark):
    return mining._tx(spark, SF001).cache()


def test_itemset_supports_by_brute_force(spark, tx):
    rows = [set(r["items"]) for r in tx.collect()]
    n = len(rows)
    fi = patterns.frequent_itemsets(tx, 0.05, 3)
    got = {tuple(r["items"]): r["freq"] for r in fi.collect()}
    k = patterns.min_count(0.05, n)
    items = sorted({i for r in rows for i in r})
    want = {}
    for size in (1, 2, 3):
        for combo in combinations(items, size):
            c = sum(1 for r in rows if set(combo) <= r)
            if c >= k:
                want[combo] = c
    assert got == want


def test_rules_anti_monotone_and_metrics(spark, tx):
    fi = patterns.frequent_itemsets(tx, 0.05, 3)
    rules = patterns.association_rules(fi, 0.1).collect()
    assert rules
    for r in rules:
        assert set(r["antecedent"]).isdisjoint(r["consequent"])
        assert r["confidence"] >= 0.1 - 1e-12 and r["confidence"] <= 1 + 1e-12
        assert r["support"] <= min(1.0, r["support"] / r["confidence"]) + 1e-12


def test_target_rule_pushdown_equals_post_filter(spark, tx):
    fi = patterns.frequent_itemsets(tx, 0.05, 3)
    pre = patterns.association_rules(fi, 0.1, consequent_prefix="priceBin=")
    post = patterns.association_rules(fi, 0.1).where(F.exists("consequent", lambda x: x.startswith("priceBin=")))
    key = lambda df: sorted((tuple(r["antecedent"]), tuple(r["consequent"])) for r in df.collect())
    assert key(pre) == key(post)


def test_folds_cover_every_row_once(spark):
    s = sale(spark, SF001)
    f = s.select(models.fold_of("sale_id", 10).alias("f"))
    assert f.where(F.col("f").isNull()).count() == 0
    assert f.agg(F.min("f"), F.max("f")).first() == (0, 9)
    train, test = models.holdout(s, "sale_id", 0.1)
    assert train.count() + test.count() == s.count()
    assert train.join(test, "sale_id").count() == 0


def test_kmeans_segments_partition_rows(spark):
    df = model_plans.kmeans_segments(spark, SF001)
    assert df.count() == sale(spark, SF001).count()
    assert df.select("MarketSegment").distinct().count() <= 5


def test_isolation_forest_share(spark):
    s = sale(spark, SF001)
    forest = outliers.IsolationForest(["area", "acctbal", "price"], trees=50, contamination=0.05, seed=1).fit(s, "sale_id")
    out = forest.outliers(s, "sale_id")
    share = out.agg(F.avg("is_outlier")).first()[0]
    assert 0.02 <= share <= 0.08


def test_isolation_forest_samples(spark):
    """Trees draw from all rows, by key: every one holds min(256, n), and another
    partitioning of the rows flags the same keys."""
    s = sale(spark, SF001).select("sale_id", "area", "acctbal", "price")
    forest = outliers.IsolationForest(["area", "acctbal", "price"], trees=20, contamination=0.01, seed=1)
    one = forest.fit(s, "sale_id")
    sizes = set(one.forest.loc[one.forest.node == 0, "size"])
    assert sizes == {min(256, s.count())}
    flags = {r["sale_id"] for r in one.outliers(s, "sale_id").where("is_outlier = 1").collect()}
    again = s.repartition(13, "price")
    two = outliers.IsolationForest(["area", "acctbal", "price"], trees=20, contamination=0.01, seed=1).fit(again, "sale_id")
    assert flags == {r["sale_id"] for r in two.outliers(again, "sale_id").where("is_outlier = 1").collect()} and flags


def test_batch_score_non_negative(spark):
    sub = model_plans.batch_score(spark, SF001)
    assert sub.count() > 0
    assert sub.where(F.col("SalePrice") < 0).count() == 0


def test_ridge_matches_numpy(spark):
    import numpy as np

    s = model_plans.cleaned(spark, SF001).withColumn("y", F.log1p("price"))
    cols = ["area", "acctbal", "yr_built"]
    coef = {r["feature"]: r["coef"] for r in models.ridge_fit(s, "y", cols, alpha=5.0).collect()}
    pdf = s.select("y", *cols).toPandas()
    x = pdf[cols].to_numpy(float)
    x = (x - x.mean(0)) / x.std(0)
    y = pdf["y"].to_numpy() - pdf["y"].mean()
    w = np.linalg.solve(x.T @ x + 5.0 * np.eye(3), x.T @ y)
    assert [coef[c] for c in cols] == pytest.approx(list(w), rel=1e-6)


def test_repartitioned_input_same_result(spark):
    from sifter.operators import ranks

    s = sale(spark, SF001)
    a = ranks.exact_quantiles(s, "price", [0.5], ["nbhd"]).collect()
    b = ranks.exact_quantiles(s.repartition(13, "sale_id"), "price", [0.5], ["nbhd"]).collect()
    assert sorted((r["nbhd"], r["q"]) for r in a) == sorted((r["nbhd"], r["q"]) for r in b)
