"""Newton boosting against a plain version, tree by tree."""

import math
import pickle

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sifter.operators import boosting
from sifter.operators.boosting import MISSING, boost, columns_of, drawn

NUMERIC, CATEGORICAL = ["a", "b", "c"], ["kind", "many"]
SCHEMA = "id long, a double, b int, c double, kind string, many string, y double, lot int"


def table(n=500, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a = None if rng.random() < 0.1 else float(rng.integers(0, 40)) / 4
        b, c = int(rng.integers(0, 6)), float("nan") if rng.random() < 0.05 else float(rng.normal())
        kind = rng.choice(["x", "y", "z", None])
        many = None if rng.random() < 0.05 else f"v{int(rng.integers(0, 150))}"
        y = (a or 3.0) + 2 * (b == 2) + (kind == "y") * 1.5 + (0 if many is None else int(many[1:]) % 7) * 0.5 + rng.normal() * 0.2
        rows.append((i, a, b, c, None if kind is None else str(kind), many, float(y), int(rng.integers(0, 4))))
    return rows


def plain_gain(g, n, gl, nl, lam):
    return gl * gl / (nl + lam) + (g - gl) ** 2 / (n - nl + lam) - g * g / (n + lam)


def plain_tree(x, g, chosen, features, categorical, depth, lam, rate, gamma, least, most):
    """Nested (value, split, left, right), by trying every cut of every feature row by row."""

    def leaf(rows):
        return -g[rows].sum() / (len(rows) + lam) * rate

    def grow(rows, level):
        best = None
        if level < depth:
            for j in features:
                v = x[rows, j]
                codes = sorted(set(v.tolist()) - {MISSING})
                if categorical[j]:
                    weight = {c: -g[rows][v == c].sum() / ((v == c).sum() + lam) for c in codes}
                    codes = sorted(codes, key=lambda c: (weight[c], c))
                for missing_left in (False, True):
                    for k in range(len(codes)):
                        if categorical[j] and min(k + 1, len(codes) - k - 1) > most:
                            continue
                        left = np.isin(v, codes[: k + 1]) | ((v == MISSING) & missing_left)
                        nl, n = left.sum(), len(rows)
                        if nl < least or n - nl < least:
                            continue
                        gain = plain_gain(g[rows].sum(), n, g[rows][left].sum(), nl, lam)
                        if best is None or gain > best[0]:
                            best = (gain, j, rows[left], rows[~left], missing_left)
        if best is None or best[0] < gamma or best[0] <= 1e-6:
            return (leaf(rows),)
        return (best[0], best[1], best[4], grow(best[2], level + 1), grow(best[3], level + 1))

    return grow(np.flatnonzero(chosen), 0)


def nested(tree, k=0):
    node = tree[k]
    if node.feature is None:
        return (node.value,)
    return (node.gain, node.feature, node.missing_left, nested(tree, node.left), nested(tree, node.right))


def same(a, b):
    assert len(a) == len(b), (a, b)
    for x, y in zip(a, b):
        same(x, y) if isinstance(x, tuple) else (x == y or pytest.approx(y, rel=1e-9, abs=1e-9) == x) or pytest.fail(f"{x} {y}")


def encoded(spark, df, fit):
    rows = boosting.encode(df, NUMERIC, CATEGORICAL, fit.edges, [F.col("id"), F.xxhash64("id").alias("hash"), F.col("y")]).orderBy("id").collect()
    return np.array([r.x for r in rows]), np.array([r.hash for r in rows]), np.array([r.y for r in rows])


def test_equals_plain_version_tree_by_tree(spark, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)  # scores are written in between
    df = spark.createDataFrame(table(), SCHEMA).repartition(5)
    rounds, rate, seed = 5, 0.3, 42
    fit = boost(df, "id", F.col("y"), NUMERIC, CATEGORICAL, rounds=rounds, rate=rate, depth=4, bins=32)[0]
    x, hashes, y = encoded(spark, df, fit)
    assert len(fit.trees) == rounds and (x[:, 0] == MISSING).sum() > 20 and (x[:, 4] == MISSING).any()
    scale = 2.0 ** min(40, 61 - math.ceil(math.log2(len(y) * 2 * (y.max() - y.min()))))
    score = np.full(len(y), fit.base)
    for r, tree in enumerate(fit.trees):
        g = np.rint((score - y) * scale) / scale
        chosen = drawn(hashes, r, seed, 0.7)
        assert 0.6 < chosen.mean() < 0.8 and len(columns_of(r, seed, 5, 0.8)) == 4
        same(nested(tree), plain_tree(x, g, chosen, columns_of(r, seed, 5, 0.8), [False] * 3 + [True] * 2, 4, 1.0, rate, 0.1, 1, boosting.MAX_SET))
        score = score + boosting.values(tree)[boosting.land(tree, x)]
    got = {r.id: r.pred_log for r in fit.predict(df, "id").collect()}
    assert np.allclose([got[i] for i in range(len(y))], score)
    assert np.sqrt(((score - y) ** 2).mean()) < 0.6 * y.std()
    shares = {r.feature: r.importance for r in fit.importances(spark).collect()}
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) in ("a", "many")


def test_folds_share_passes_and_equal_single_fits(spark):
    df = spark.createDataFrame(table(300, 1), SCHEMA)
    kw = dict(rounds=3, rate=0.3, depth=3, bins=16)
    both = boost(df, "id", F.col("y"), NUMERIC, CATEGORICAL, lot=F.col("lot"), held=[0, 2], **kw)
    for m, lot in enumerate((0, 2)):
        alone = boost(df.repartition(7), "id", F.col("y"), NUMERIC, CATEGORICAL, lot=F.col("lot"), held=[lot], **kw)[0]
        for a, b in zip(both[m].trees, alone.trees, strict=True):
            same(nested(a), nested(b))


def test_stopping_ends_training(spark):
    df = spark.createDataFrame(table(400, 2), SCHEMA)
    kw = dict(rate=1.0, depth=4, bins=16, colsample=1.0, gamma=0.0, lot=F.col("lot"), held=[1])
    fit = boost(df, "id", F.col("y"), NUMERIC, CATEGORICAL, rounds=60, patience=4, **kw)[0]
    assert fit.rounds_kept == int(np.argmin(fit.errors)) + 1 and fit.rounds_tried == fit.rounds_kept + 4 < 60
    full = boost(df, "id", F.col("y"), NUMERIC, CATEGORICAL, rounds=fit.rounds_kept, **kw)[0]
    for a, b in zip(fit.trees, full.trees, strict=True):
        same(nested(a), nested(b))
    scored = fit.predict(df.where("lot = 1"), "id").join(df, "id")
    rmse = scored.agg(F.sqrt(F.avg(F.pow(F.col("pred_log") - F.col("y"), 2)))).first()[0]
    assert rmse == pytest.approx(min(fit.errors), rel=1e-6)


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    fit = boost(none, "id", F.col("y"), NUMERIC, CATEGORICAL, rounds=2)[0]
    assert fit.trees == [] and fit.predict(none, "id").collect() == []
    blank = spark.createDataFrame([(i, None, None, None, None, None, float(i), 0) for i in range(9)] + [(9, 1.0, 1, 1.0, "x", "x", None, 0)], SCHEMA)
    fit = boost(blank, "id", F.col("y"), NUMERIC, CATEGORICAL, rounds=2, subsample=1.0)[0]
    assert [len(t) for t in fit.trees] == [1, 1]  # all-null columns give no split
    assert np.allclose([r.pred_log for r in fit.predict(blank, "id").collect()], 4.0)


def test_a_pass_sends_a_row_a_node_and_feature_not_one_a_code(spark):
    x = np.stack([np.arange(300) % 50, np.arange(300) % 7 + 10**12], axis=1)
    job = boosting._Pass([[]], [[boosting.Node()]], [[0]], [0, 1], [False, True], [52, 0], [-2], 0, 1, 1.0, 2.0**20, 2.0**20, False)
    plain = [pa.array(v) for v in (np.arange(300), np.zeros(300, np.int32), np.arange(300) / 10)]
    columns = [*plain, boosting._packed(x), boosting._packed(np.zeros((300, 1)))]
    batch = pa.RecordBatch.from_arrays(columns, names=["hash", "lot", "y", "x", "score"])
    out = [r for b in boosting._sums(iter([batch.slice(0, 100), batch.slice(100)]), job) for r in b.to_pylist()]
    assert [(r["node"], r["feature"], len(r["code"]), sum(r["n"])) for r in out] == [(0, 0, 50, 300), (0, 1, 7, 300)]
    assert out[1]["code"] == sorted(set(x[:, 1].tolist())) and sum(out[0]["g"]) == sum(out[1]["g"])


def test_many_levels_are_added_up_by_code_first_with_the_same_trees(spark, monkeypatch):
    df = spark.createDataFrame(table(300, 2), SCHEMA).repartition(3)
    kw = dict(rounds=2, rate=0.3, depth=3, bins=16)
    few = boost(df, "id", F.col("y"), NUMERIC, CATEGORICAL, **kw)[0]
    monkeypatch.setattr(boosting, "WIDE", 10)
    many = boost(df, "id", F.col("y"), NUMERIC, CATEGORICAL, **kw)[0]
    assert [nested(t) for t in few.trees] == [nested(t) for t in many.trees]


KINDS = [False] * 3 + [True] * 2


def coded_table(n, seed):
    rng = np.random.default_rng(seed)
    levels = [np.append(rng.integers(1, 2**62, 6), MISSING), rng.integers(-(2**62), 2**62, 90)]
    x = [rng.integers(-1, w, n) for w in (30, 5, 12)] + [known[rng.integers(0, len(known), n)] for known in levels]
    return x, [31, 6, 13, 0, 0]


def grown(x, depth, seed):
    """A full tree of splits at codes of its rows."""
    rng, tree, ends = np.random.default_rng(seed), [boosting.Node(0.1)], [0]
    for _ in range(depth):
        after = []
        for k in ends:
            node, j = tree[k], int(rng.integers(0, len(x)))
            node.feature, node.missing_left, node.inside = j, bool(rng.integers(2)), bool(rng.integers(2))
            if KINDS[j]:
                node.codes = np.append(np.unique(x[j])[1::3], 7)  # 7: a level no row has
            else:
                node.cut = int(rng.integers(0, x[j].max() + 1))
            node.left, node.right = len(tree), len(tree) + 1
            tree += [boosting.Node(float(v)) for v in rng.normal(size=2)]
            after += [node.left, node.right]
        ends = after
    return tree, ends


def test_looked_up_rows_end_where_walked_ones_do():
    x, widths = coded_table(700, 5)
    coded = boosting._Coded.of(x, KINDS, widths)
    plain = np.stack(x, axis=1)
    for depth in (0, 1, 4, 6, 7):  # words of 32 and of 64 bits; beyond them trees are walked
        trees = [grown(x, depth, s)[0] for s in range(3)] + [[boosting.Node(0.5)]]
        layout = boosting._Layout(coded, [2], range(5), widths)
        look, cells = boosting._Look([boosting._Sent(t) for t in trees], layout), layout.cells(coded)
        places = np.concatenate([look.at(coded, cells, slice(a, a + 300)) for a in range(0, 700, 300)])
        ends = look.by_end([np.arange(len(t)) for t in trees]).take(places)
        assert all((ends[:, m] == boosting.land(t, plain)).all() for m, t in enumerate(trees))
        got = np.zeros((700, 2))
        boosting._Sum([trees[:2], trees[2:]], layout).add(got, coded, cells, slice(0, 700))
        assert (got[:, 0] == boosting.values(trees[0])[boosting.land(trees[0], plain)] + boosting.values(trees[2])[boosting.land(trees[2], plain)]).all()
        assert [pickle.loads(pickle.dumps(boosting._Sent(t)))[0].feature for t in trees] == [t[0].feature for t in trees]


def test_a_pass_over_blocks_gives_the_sums_of_its_rows(monkeypatch):
    for name, size in {"BLOCK": 90, "CHUNK": 200, "STEP": 64, "CELLS": 40}.items():
        monkeypatch.setattr(boosting, name, size)
    x, widths = coded_table(700, 6)
    rng = np.random.default_rng(1)
    hashes, lot, y = rng.integers(-(2**62), 2**62, 700), rng.integers(0, 3, 700).astype(np.int32), rng.normal(size=700)
    batch = pa.RecordBatch.from_arrays([pa.array(v) for v in (hashes, lot, y)], names=["hash", "lot", "y"])
    blocks = [b.slice(i, 1) for b in boosting._blocks(iter([(batch, x)]), KINDS, widths) for i in range(b.num_rows)]
    assert len(blocks) == 8 and sum(b.column("n")[0].as_py() for b in blocks) == 700  # a record a block, not a row
    trees, growing = [[grown(x, 3, s)[0]] for s in range(2)], [grown(x, 2, s) for s in (7, 8)]
    held, features, scale = [0, 2], [0, 1, 3, 4], 2.0**30
    job = boosting._Pass(trees, [t for t, _ in growing], [f for _, f in growing], features, KINDS, widths, held, 3, 42, 0.7, scale, scale, True, [0.25, 0.5])
    got, errors = {}, {}
    for r in (r for b in boosting._sums(iter(blocks), job) for r in b.to_pylist()):
        if r["node"] < 0:
            errors[r["fit"]] = r["g"][0] / scale, r["n"][0]
        for code, g, n in zip(r["code"], r["g"], r["n"]):
            got[r["fit"], r["node"], r["feature"], code] = (g, n)
    plain, want = np.stack(x, axis=1), {}
    chosen = drawn(hashes, 3, 42, 0.7)
    for m, (tree, ends) in enumerate(growing):
        f = job.base[m] + boosting.values(trees[m][0])[boosting.land(trees[m][0], plain)]
        assert errors[m] == (pytest.approx(((f - y) ** 2)[lot == held[m]].sum(), rel=1e-6), (lot == held[m]).sum())
        want[m, -1, -1, 0] = got[m, -1, -1, 0]
        at = boosting.land(tree, plain)
        for i in np.flatnonzero(chosen & (lot != held[m])):
            for j in features:
                key = m, ends.index(at[i]), j, int(plain[i, j])
                g, n = want.get(key, (0, 0))
                want[key] = g + int(np.rint((f[i] - y[i]) * scale)), n + 1
    assert got == want


def test_rows_left_out_are_scored_from_the_blocks(spark):
    df = spark.createDataFrame(table(300, 3), SCHEMA).repartition(3)
    fits = boost(df, "id", F.col("y"), NUMERIC, CATEGORICAL, lot=F.col("lot"), held=[2, 0], rounds=3, rate=0.3, depth=3, bins=16)
    got = sorted((r.lot, r.label, r.pred_log) for r in boosting.predict_left_out(fits, [2, 0]).collect())
    own = df.where("lot in (0, 2)")
    each = boosting.predict_each(own, "id", fits, F.when(F.col("lot") == 2, 0).otherwise(1)).join(own, "id")
    want = sorted((r.lot, r.y, r.pred_log) for r in each.collect())
    assert len(got) == own.count() and np.allclose(got, want, rtol=0, atol=1e-12)


def test_cross_validate_gives_mean_and_std_beside_its_folds(spark, monkeypatch):
    from sifter.plans import models as plans

    rng = np.random.default_rng(4)
    rows = [(i, float(rng.uniform(50, 500)), *map(float, rng.normal(size=6)), *(str(rng.integers(0, 4)) for _ in range(5))) for i in range(400)]
    names = ["sale_id", "price", *plans.NUMERIC, *plans.CATEGORICAL]
    monkeypatch.setattr(plans, "cleaned", lambda spark, d: spark.createDataFrame(rows, names))
    monkeypatch.setattr(plans, "GBT", dict(plans.GBT, rounds=2))
    got = plans.QUERIES["cross_validate"](spark, None).collect()
    assert sorted(r.fold for r in got) == list(range(10)) and sum(r.n for r in got) == 400
    for m in ("r2", "rmse", "mae"):
        folds = np.array([r[m] for r in got])
        for r in got:
            assert r[f"{m}_mean"] == pytest.approx(folds.mean(), abs=2e-6) and r[f"{m}_std"] == pytest.approx(folds.std(), abs=2e-6)
