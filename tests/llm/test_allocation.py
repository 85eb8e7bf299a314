"""Sharding, mixing, search and toxicity against their contracts and plain versions."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sifter.llm import mixing, sharding, topk, toxicity


def test_sharding(spark, odd, none):
    rows = [(i, f"text {i % 50}" if i < 300 else f"own {i}") for i in range(1001)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.balanced_shards(df, shards=7).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(map(len, slots.values())) == [143] * 7 and all(sorted(s) == list(range(143)) for s in slots.values())
    assert sorted(r.doc_id for r in got) == list(range(1001))
    # linked documents come together: most groups of six lie in one shard
    where = defaultdict(set)
    for r in got:
        if r.doc_id < 300:
            where[r.doc_id % 50].add(r.shard)
    assert sum(len(s) == 1 for s in where.values()) >= 45
    got = sharding.balanced_shards(odd).collect()
    text = {(r.doc_id, r.text) for r in odd.collect()}
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ((r.doc_id, r.text) for r in odd.collect()))
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want and text
    count = Counter(r.shard for r in got)
    assert max(count.values()) <= 1
    assert sharding.balanced_shards(none).count() == 0


def test_one_group_above_all_shards(spark):
    got = sharding.balanced_shards(spark.createDataFrame([(i, "same") for i in range(100)], "doc_id long, text string"), shards=8).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [12, 12, 12, 12, 13, 13, 13, 13]


def whole_groups(spark, sizes, total, shards=40):
    """Of groups of these sizes among ``total`` rows, the number that lie in one shard."""
    texts = [f"group {g}" for g, m in enumerate(sizes) for _ in range(m)]
    rows = [(i, texts[i] if i < len(texts) else f"own {i}") for i in range(total)]
    got = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=shards).collect()
    slots, where = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        where[rows[r.doc_id][1]].add(r.shard)
    assert sorted(r.doc_id for r in got) == list(range(total)) and max(map(len, slots.values())) - total // shards in (0, 1)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [len(where[f"group {g}"]) for g in range(len(sizes))]


def test_pairs_come_together_where_all_rows_are_linked(spark):
    for shards in (4, 40):
        rows = [(i, f"text {i % 1000}") for i in range(2000)]
        got = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=shards).collect()
        assert sorted(Counter(r.shard for r in got).values()) == [2000 // shards] * shards
        where = {r.doc_id: r.shard for r in got}
        assert sum(where[i] == where[i + 1000] for i in range(1000)) >= 1000 - 2 * shards


def test_groups_below_a_shard_stay_whole(spark):
    # pairs among few rows: shards of five hold two pairs each
    assert set(whole_groups(spark, [2] * 50, 200)) == {1}
    assert whole_groups(spark, [2] * 100, 200).count(1) == 80
    # shards of 100: groups of a quarter, a half, a whole one, and above it
    spread = whole_groups(spark, [25] * 6 + [50] * 5 + [100, 250] + [3] * 10, 1000, shards=10)
    assert set(spread[:12]) == {1} and spread[12] == 3


def plain_targets(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_mixing(spark, odd, none):
    rng = np.random.default_rng(4)
    rows = []
    for s, n in (("a", 200), ("B", 3), ("é", 80), (None, 40), ("zz", 1), ("hot", 600)):
        rows += [(len(rows) + k, " ".join(["w"] * int(rng.integers(0, 60))), s) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.entropy_mix(df).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = plain_targets(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, r.target) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= max(60, 0.02 * want[s]), s
    again = mixing.entropy_mix(df.repartition(7)).collect()
    assert {r.doc_id: r.copies for r in again} == {r.doc_id: r.copies for r in got}
    whole = mixing.entropy_mix(df, whole=True)
    assert whole.columns == df.columns
    assert Counter(r.doc_id for r in whole.collect()) == Counter({r.doc_id: r.copies for r in got if r.copies})
    assert len(mixing.entropy_mix(odd).collect()) == odd.count()
    assert mixing.entropy_mix(odd, whole=True).columns == odd.columns
    assert mixing.entropy_mix(none).count() == 0


@pytest.mark.parametrize("blocks", [(8192, 256), (7, 2)])
def test_top_k(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    monkeypatch.setattr(topk, "GROUP", 2 * blocks[1])
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)], "x") for i in range(60)]
    rows += [(100 + i, rows[3][1], "copy") for i in range(15)]
    rows += [(200, None, "n"), (201, [1.0, None], "n"), (202, [float("nan")], "n"), (203, [float("inf")], "n"), (204, [], "e"), (205, [0.5, 0.25], "short"), (None, [1.0], "n")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = topk.top_k(df, "vec_id % 5 = 0").collect()
    ints = {i: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in ints:
        if q % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:10])}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    assert topk.top_k(df.limit(0), "vec_id % 5 = 0").count() == 0
    assert topk.top_k(df.where("vec_id = 5"), "vec_id % 5 = 0").count() == 0


def test_gradients():
    rng = np.random.default_rng(1)
    dim = toxicity.WORD_DIM + toxicity.CHAR_DIM
    h = toxicity.HIDDEN
    p = {k: rng.normal(size=s) * 0.4 for k, s in {"wf": (dim, 3 * h), "uf": (h, 3 * h), "bf": (3 * h,), "wb": (dim, 3 * h), "ub": (h, 3 * h), "bb": (3 * h,), "wa": (2 * h, 8), "va": (8,), "out": (2 * h,), "bias": (1,)}.items()}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    x, y = rng.normal(size=(3, 5, dim)).astype(np.float32), np.array([1.0, 0.0, 1.0], np.float32)

    def loss(q, x):
        z = toxicity.logits(x, q).astype(float)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    g, dx = toxicity.gradients(x, y, p)
    for name in p:
        at = tuple(int(rng.integers(n)) for n in p[name].shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert abs((loss(up, x) - loss(down, x)) / 2e-2 - g[name][at]) < 2e-3, name
    up, down = x.copy(), x.copy()
    up[1, 2, 3] += 1e-2
    down[1, 2, 3] -= 1e-2
    assert abs((loss(p, up) - loss(p, down)) / 2e-2 - dx[1, 2, 3]) < 2e-3


def test_windows_cover_texts():
    for n in (0, 1, 64, 65, 112, 113, 500):
        codes = list(range(1, n + 1))
        windows = toxicity.windows_of(codes)
        assert set(windows.ravel()) - {0} == set(codes) and windows.shape[1] == toxicity.WINDOW


def test_toxicity_held_out_accuracy(spark, odd, none):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(got[r.doc_id], r.toxic) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held)
    pos, neg = [r.score for r, y in held if y], [r.score for r, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    # labels of held-out rows change nothing
    few = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    one = toxicity.toxicity(odd, few)
    assert one.count() == odd.count() and toxicity.toxicity(none, few).count() == 0
    assert toxicity.toxicity(odd, few.limit(0)).where("score = 0").count() == odd.count()
