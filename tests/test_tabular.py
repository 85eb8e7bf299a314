"""Columns without values, wide correlation, tiers by fold, k-means and forest against plain versions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sifter.operators import binning, dependence, models, outliers, profile
from sifter.operators.models import fold_of


@pytest.fixture(scope="module")
def blank(spark):
    return spark.createDataFrame([(i, None, 5.0) for i in range(4)], "id int, v double, same double")


def test_columns_without_values(spark, blank):
    none = blank.where("id < 0")
    for df in (blank, none):
        row = profile.box_stats(df, "v").first()
        assert row.q1 is None and row.whisker_low is None and not row.n_outliers
        assert profile.box_stats(df, "v", by="id").collect() == []
        assert profile.density_grid(df, "v").collect() == [] and profile.density_grid(df, "v").columns == ["point", "x", "density"]
        assert binning.histogram(df, "v").collect() == [] and binning.histogram(df, "v").columns == ["bin", "lo", "hi", "count"]
        assert [r.v for r in binning.cut_equal_width(df, "v", 4).collect()] == [None] * df.count()
        assert [r.o for r in binning.cut_equal_width(df, "v", 2, ["a", "b"], "o").collect()] == [None] * df.count()
    assert profile.density_grid(blank, "same").collect() == []


def test_fitted_band(spark, blank):
    assert profile.fitted_band(blank, "id", "id", "v").collect() == [] == profile.fitted_band(blank, "id", "same", "id").collect()
    rng = np.random.default_rng(6)
    x = rng.normal(size=400)
    y = 2 * x + 1 + rng.normal(size=400)
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(np.stack([x, y], axis=1).tolist())], "id int, x double, y double")
    band = profile.fitted_band(df, "id", "x", "y", points=5, replicates=200).orderBy("point").collect()
    slope, base = np.polyfit(x, y, 1)
    assert np.allclose([r.fit for r in band], [slope * r.x + base for r in band]) and all(r.low < r.fit < r.high for r in band)
    se = np.sqrt(((y - slope * x - base) ** 2).sum() / 398 / ((x - x.mean()) ** 2).sum())
    assert (band[-1].high - band[-1].low) / (2 * 1.96 * se * (band[-1].x - x.mean())) == pytest.approx(1, abs=0.3)


def test_box_by_group(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 300), "v": rng.normal(size=300) ** 3})
    pdf.loc[::17, "v"] = None
    df = spark.createDataFrame([(g, None if v != v else v) for g, v in pdf.itertuples(index=False)], "g string, v double")
    got = {r.g: r for r in profile.box_stats(df, "v", by="g").collect()}
    for g, own in pdf.assign(g=pdf.g.fillna("")).dropna(subset="v").groupby("g"):
        q1, q2, q3 = own.v.quantile([0.25, 0.5, 0.75])
        inside = own.v.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        r = got[g or None]
        assert np.allclose([r.q1, r.median, r.q3, r.whisker_low, r.whisker_high], [q1, q2, q3, own.v[inside].min(), own.v[inside].max()])
        assert r.n_outliers == (~inside).sum()


def test_pearson_of_500_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 500)) * rng.choice([1e-3, 1, 1e4], 500) + rng.choice([0, 1e6], 500)
    x[:, 1:] += 0.5 * x[:, :-1]
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.25
    x[:, 8] = np.nan
    names = [f"c{i}" for i in range(500)]
    rows = [(i, [None if v != v else v for v in r]) for i, r in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "id int, x array<double>").repartition(6)
    df = df.select(*[F.col("x")[i].alias(c) for i, c in enumerate(names)])
    got = dependence.pearson_wide(df, names).toPandas()
    assert len(got) == 500 * 500
    r = got.pivot(index="col_i", columns="col_j", values="r").loc[names, names].to_numpy(float)
    x -= np.nanmedian(np.where(np.isnan(x).all(axis=0), 0.0, x), axis=0)  # no change of r, and pandas is exact to more digits
    want = pd.DataFrame(x, columns=names).corr(min_periods=2).to_numpy().copy()
    want[7, :] = want[:, 7] = want[8, :] = want[:, 8] = np.nan
    np.fill_diagonal(want, 1.0)
    assert np.nanmax(np.abs(r - want)) < 1e-8
    assert (np.isnan(r) == np.isnan(want)).all()


def test_pearson_wide_of_odd_tables(spark, blank):
    for df in (blank, blank.where("id < 0")):
        rows = {(r.col_i, r.col_j): r.r for r in dependence.pearson_wide(df, ["id", "v", "same"]).collect()}
        assert rows["id", "id"] == 1.0 and rows.get(("id", "v")) is None and rows.get(("id", "same")) is None
    assert dependence.pearson_wide(blank, []).collect() == []


def test_tiers_by_fold(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"id": range(600), "g": rng.integers(0, 12, 600).astype(str), "y": rng.normal(100, 30, 600)})
    pdf.loc[pdf.index % 31 == 0, "y"] = np.nan
    pdf.loc[599, "g"] = "alone"  # known in one fold only
    rows = [(int(i), None if i % 50 == 3 else g, None if y != y else y) for i, g, y in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "id int, g string, y double")
    out = binning.fold_group_tiers(df, "g", "y", fold_of("id", 4), 4, bins=5, out_col="t")
    got = {r.id: r.t for r in out.collect()}
    data = df.withColumn("f", fold_of("id", 4)).toPandas()
    for f in range(4):
        means = data[(data.f != f) & data.g.notna()].groupby("g").y.mean().dropna()
        tiers = pd.qcut(means, 5, labels=[f"NB_Level_{i}" for i in range(1, 6)]).to_dict()
        for i, g in data[data.f == f][["id", "g"]].itertuples(index=False):
            assert got[i] == tiers.get(g, "NB_Level_3")
    assert len(got) == 600


def plain_lloyd(x, centers, rounds=20, tol=1e-4):
    for _ in range(rounds):
        best = ((x[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[best == k].mean(axis=0) if (best == k).any() else centers[k] for k in range(len(centers))])
        if np.sqrt(((new - centers) ** 2).sum(axis=1)).max() <= tol:
            break
        centers = new
    return ((x[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum(), centers


def test_kmeans_runs_equal_single_fits(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.6, (80, 2)) for c in ((0, 0), (4, 0), (0, 4), (5, 5))])
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "hash long, x array<double>").repartition(5)
    centers, cost = models.kmeans(rows, 4, seed=1, n_init=5)
    single = [plain_lloyd(x, models._spread(x, 4, np.random.default_rng([1, i])))[0] for i in range(5)]
    assert cost == pytest.approx(min(single), rel=1e-9) and len(centers) == 4


def test_kmeans_segments(spark):
    df = spark.createDataFrame([(i, float(i % 3) * 10 + i * 0.001, None) for i in range(60)], "id int, a double, b double")
    got = {r.id: r.s for r in models.kmeans_segments(df, "id", ["a", "b"], k=3, out_col="s").collect()}
    assert all(got[i] == f"Segment_{i % 3}" for i in range(60))
    assert models.kmeans_segments(df.where("id < 0"), "id", ["a", "b"], out_col="s").collect() == []
    assert models.kmeans_segments(df.where("id < 2"), "id", ["a", "b"], k=3, out_col="s").count() == 2


def test_path_lengths_against_a_walk():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3))
    nodes = outliers._grow(0, x, rng, 6)
    feature, threshold, left, right, size = (np.array(c) for c in list(zip(*nodes))[2:])
    rest = np.array([outliers._c(s) for s in size])
    got = outliers._path_lengths(x, (feature, threshold, left, right, rest))
    for row, g in zip(x, got):
        k = depth = 0
        while feature[k] >= 0:
            k, depth = (left[k] if row[feature[k]] < threshold[k] else right[k]), depth + 1
        assert g == pytest.approx(depth + outliers._c(size[k]))


def test_fitted_band_computes_a_digest_once_a_row_and_replicate(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(50)], "id int, x double, y double")
    plans, write = [], profile.measured

    def seen(table, tag):
        plans.append(table._jdf.queryExecution().executedPlan().toString())
        return write(table, tag)

    monkeypatch.setattr(profile, "measured", seen)
    assert profile.fitted_band(df, "id", "x", "y", points=3, replicates=4).count() == 3
    assert [p.count("md5(") for p in plans] == [1]


def test_poisson_weight_equals_counting_the_chances(spark):
    digest = profile.replicate_digest("id", F.lit(3), 42)
    rows = spark.range(400).select("id", digest.alias("u")).select("u", profile.poisson_weight(F.col("u")).alias("w")).collect()
    below = np.cumsum([np.exp(-1) / math.factorial(k) for k in range(profile.POISSON)])
    assert [r.w for r in rows] == [int((int(r.u[:8], 16) / 2**32 >= below).sum()) for r in rows]
