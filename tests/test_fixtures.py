"""Tiny hand fixtures with expected values from pandas semantics (FIXTURES.md §4)."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from sifter.functions.exprs import LABELS_5, equal_width_edges
from sifter.operators import binning, boosting, dependence, features, impute, models, patterns, profile, ranks


def test_equal_width_edges_integers():
    e = equal_width_edges(0.0, 4.0, 5)
    assert e == pytest.approx([-0.004, 0.8, 1.6, 2.4, 3.2, 4.0])


def test_equal_width_edges_reference_log():
    e = equal_width_edges(876.0, 29450.0, 10)
    assert round(e[0], 3) == 847.426
    assert e[1] == pytest.approx(3733.4)


def test_quantile_fallback_to_equal_width(spark):
    df = spark.createDataFrame([(float(v),) for v in [0] * 50 + [1, 2, 3]], "x double")
    plan = binning.fit_discretize(df, target="none", bins=5, cols=["x"])
    assert plan.edges["x"] == pytest.approx(equal_width_edges(0.0, 3.0, 5))
    out = [r["x"] for r in plan.transform(df).collect()]
    assert out.count("Muito Baixo") == 50 and out[-1] == "Muito Alto"


def test_merged_quantile_codes(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 2, 3]], "x double")
    out = binning.qcut_codes(df, "x", 4, out_col="c").orderBy("x").collect()
    assert [r["c"] for r in out] == [0, 0, 0, 0, 1, 1]


def test_mode_lowest_tie(spark):
    df = spark.createDataFrame([(v,) for v in [3, 1, 3, 1, 2]], "x long")
    assert ranks.modes(df, "x").first()["mode"] == 1


def test_group_mode_lowest_bin(spark):
    # labels tied: the lower bin wins, not the alphabetically first label
    df = spark.createDataFrame([("g", 2), ("g", 1)], "g string, b int")
    m = ranks.modes(df, "b", ["g"]).first()["mode"]
    assert LABELS_5[m - 1] == "Muito Baixo"


def test_group_median_fill(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, None), (3, "a", 3.0), (4, "a", None)], "id int, g string, v double")
    out = {r["id"]: r["v"] for r in impute.group_median_fill(df, "v", ["g"]).collect()}
    assert out == {1: 1.0, 2: None, 3: 3.0, 4: 2.0}


def test_factorize_alphabetical(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id int, c string")
    out = {r["id"]: r["c_code"] for r in features.factorize(df, ["c"], suffix="_code").collect()}
    assert out == {1: 1, 2: 0, 3: -1, 4: 1}


def test_one_hot_drop_first(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, a string")
    out = features.one_hot_drop_first(df, ["a"]).orderBy("id").collect()
    assert [c for c in out[0].asDict() if c != "id"] == ["a_y"]
    assert [r["a_y"] for r in out] == [0, 1, 0]


def test_null_item_renders_nan_and_dedup(spark):
    df = spark.createDataFrame([(1, None, "v")], "id int, c string, d string")
    tx = patterns.transactions(df, ["c", "d", "d"], "id").first()
    assert tx["items"] == ["c=nan", "d=v"]


def test_exact_quantiles_match_pandas(spark):
    import numpy as np

    vals = [5.0, 1.0, 7.0, 3.0, 3.0, 9.0, 2.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0, 0.1, 0.25, 0.5, 0.9, 1]
    q = sorted(ranks.exact_quantiles(df, "x", probs).collect(), key=lambda r: r["p_idx"])
    assert [r["q"] for r in q] == pytest.approx(list(np.quantile(vals, probs)))


def test_cumulative_counts_over_partitions(spark):
    rows = [(str(i % 7), float((i * 7919) % 1013)) for i in range(5000)]
    got = ranks.cumulative_counts(spark.createDataFrame(rows, "g string, v double"), "v", ["g"], num_partitions=5).collect()
    for r in got:
        own = [v for g, v in rows if g == r["g"]]
        assert (r["n"], r["n_before"], r["n_group"]) == (own.count(r["v"]), sum(v < r["v"] for v in own), len(own))
    assert len(got) == len(set(rows))


def test_flag_scores_alike_as_number_and_text(spark):
    rows = [(float(i), int(i % 20 < 7), "y" if i % 20 < 7 else "n", i % 4) for i in range(400)]
    df = spark.createDataFrame([(p + 500 * f, f, t, k) for p, f, t, k in rows], "price double, flag int, text string, k int")
    mi = {r["feature"]: r["mi"] for r in dependence.mutual_information(df, "price", ["flag", "k"], ["text"]).collect()}
    assert mi["flag"] == pytest.approx(mi["text"]) and mi["flag"] > 0.3


def test_rules_keep_items_with_separators_apart(spark):
    tx = spark.createDataFrame([(1, ["a|b", "c"]), (2, ["a|b", "c"]), (3, ["a", "b|c"])], "tid int, items array<string>")
    rules = patterns.association_rules(patterns.frequent_itemsets(tx, 0.1), 0.1).collect()
    got = {(tuple(r["antecedent"]), tuple(r["consequent"])): round(r["support"], 6) for r in rules}
    assert got == {(("a|b",), ("c",)): 0.666667, (("c",), ("a|b",)): 0.666667, (("a",), ("b|c",)): 0.333333, (("b|c",), ("a",)): 0.333333}
    text = [r["antecedent"] for r in patterns.rules_as_text(patterns.association_rules(patterns.frequent_itemsets(tx, 0.1), 0.1)).collect()]
    assert sorted(text) == ["a", "a\\|b", "b\\|c", "c"]


def test_sequential_patterns_of_any_length(spark):
    sequences = ["abcab", "abc", "acb", "bca", "aaa"]
    df = spark.createDataFrame([(s, k, c) for s in sequences for k, c in enumerate(s)], "s string, k int, c string")

    def has(s, p):
        it = iter(s)
        return all(c in it for c in p)

    every = {"".join(p) for n in range(1, 6) for p in itertools.product("abc", repeat=n)}
    want = {p: n for p in every if (n := sum(has(s, p) for s in sequences)) >= 2}
    got = {"".join(r["pattern"]): r["freq"] for r in patterns.sequential_patterns(df, "s", ["k"], "c", 0.4).collect()}
    assert got == want
    short = patterns.sequential_patterns(df, "s", ["k"], "c", 0.4, max_length=2).collect()
    assert {"".join(r["pattern"]): r["freq"] for r in short} == {p: n for p, n in want.items() if len(p) <= 2}
    weighted = df.where("s <> 'abc'").withColumn("w", F.when(F.col("s") == "acb", 2).otherwise(1))
    got = patterns.sequential_patterns(weighted, "s", ["k"], "c", 0.4, weight_col="w").collect()
    counts = {"abcab": 1, "acb": 2, "bca": 1, "aaa": 1}
    assert {"".join(r["pattern"]): r["freq"] for r in got} == {p: n for p in every if (n := sum(w for s, w in counts.items() if has(s, p))) >= 2}


def test_groups_without_key_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "g string, v double")
    assert [tuple(r) for r in profile.group_stats(df, "g", "v").select("g", "mean", "median", "count").collect()] == [("a", 2.0, 2.0, 2)]
    assert [tuple(r) for r in profile.group_mean(df, "g", "v").collect()] == [("a", 2.0)]


def test_stopped():
    assert not boosting.stopped([], 1) and not boosting.stopped([3, 2, 1, 2, 3], 3)
    assert boosting.stopped([3, 2, 1, 2, 3], 2) and boosting.stopped([1, 1], 1)  # a tie is no better round


def test_sample_moments_are_bias_corrected(spark):
    import pandas as pd

    vals = [1.0, 2.0, 2.0, 3.0, 10.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    m = profile.moments(df, ["x"]).first()
    s = pd.Series(vals)
    assert m["skew"] == pytest.approx(s.skew()) and m["kurt"] == pytest.approx(s.kurt())


def test_null_safe_threshold_keeps_null_rows(spark):
    from sifter.functions.exprs import null_false

    df = spark.createDataFrame([(None, 1.0), (5000.0, 1.0), (10.0, 200000.0), (10.0, 1.0)], "a double, b double")
    kept = df.where(~null_false((F.col("a") > 4000) | (F.col("b") > 100000))).count()
    assert kept == 2


def test_kde_integrates_to_one(spark):
    df = spark.range(0, 2000).select((F.col("id") % 97 * 1.0).alias("x"))
    g = profile.density_grid(df, "x", 200).orderBy("point").collect()
    step = g[1]["x"] - g[0]["x"]
    assert sum(r["density"] for r in g) * step == pytest.approx(1.0, abs=0.08)
    assert all(not math.isnan(r["density"]) for r in g)


def test_csv_sentinels_become_null(spark, tmp_path):
    from sifter.sources import files

    p = tmp_path / "t.csv"
    p.write_text("Id,MasVnrType,LotFrontage,Alley\n1,None,65,NA\n2,BrkFace,N/A,Grvl\n3,Stone,NaN,\n")
    df = files.read_csv(spark, str(p), "Id bigint, MasVnrType string, LotFrontage double, Alley string")
    rows = {r["Id"]: r for r in df.collect()}
    assert rows[1]["MasVnrType"] is None and rows[1]["LotFrontage"] == 65.0 and rows[1]["Alley"] is None
    assert rows[2]["LotFrontage"] is None and rows[2]["Alley"] == "Grvl"
    assert rows[3]["LotFrontage"] is None and rows[3]["Alley"] is None
    missing = files.read_or_empty(spark, str(tmp_path / "absent.csv"), "Id bigint")
    assert missing.isEmpty() and missing.columns == ["Id"]
