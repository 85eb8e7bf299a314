"""Exact dedup and the Jaccard join against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sifter.llm import exact_dedup, jaccard_join
from sifter.llm.exact_dedup import golomb_decode, golomb_encode


def test_golomb_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 1000, 70_000):
        for high in (2**20, 2**40, 2**64 - 1):
            values = np.unique(rng.integers(0, high, n, dtype=np.uint64))
            assert (golomb_decode(golomb_encode(values)) == values).all()
    values = np.unique(rng.integers(0, 2**63, 10_000, dtype=np.uint64))
    assert len(golomb_encode(values)) < 0.85 * values.nbytes


@pytest.mark.parametrize("fingerprint", [F.xxhash64, lambda c: F.length(c).cast("long")], ids=["hash", "collisions"])
def test_exact_dedup(odd, none, fingerprint):
    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    groups = Counter(t for _, t in rows)
    got = exact_dedup.exact_dedup(odd, fingerprint=fingerprint).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in rows}
    for r in got:
        text = by_sha[r.text_sha256]
        ids = [i for i, t in rows if t == text and i is not None]
        assert r.keep_id == (max(ids) if ids else None) and r.group_size == groups[text]
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert exact_dedup.exact_dedup(none).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(i, low.get(root(k), i))
    return sorted((str(i), len(sets[k]), str(low.get(root(k)))) for k, (i, _) in enumerate(rows))


def near_copies(seed=11, families=6, copies=9):
    """Families of near copies with random edits, sharing passages, and chains of edits."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(400)]
    passage = list(rng.choice(words, 40))
    texts = []
    for f in range(families):
        base = list(rng.choice(words, int(rng.integers(20, 90))))
        if f % 2:
            base = passage + base[:25]
        now = base
        for k in range(copies):
            now = list(now if f % 3 == 0 else base)
            for _ in range(int(rng.integers(0, 4))):
                now[int(rng.integers(0, len(now)))] = str(rng.choice(words))
            texts.append(" ".join(now))
    return [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]


@pytest.mark.parametrize("cell,leaf", [(4096, 16), (4, 2)])
def test_jaccard_components(spark, odd, none, monkeypatch, cell, leaf):
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    monkeypatch.setattr(jaccard_join, "FAN", leaf)
    rows = near_copies() + [(r.doc_id + 1000 if r.doc_id is not None else None, r.text) for r in odd.collect()]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == plain_components(rows)
    if cell == 4:
        assert jaccard_join.jaccard_components(none).count() == 0
        ids = jaccard_join.jaccard_components(odd).collect()
        assert len(ids) == odd.count()


@pytest.mark.parametrize("m", [1, 5, 40, 300])
def test_rtree_join(m):
    rng = np.random.default_rng(m)
    points = rng.integers(0, 6, (m, jaccard_join.GROUPS)).astype(np.int32)
    points[m // 2 :] = points[: m - m // 2]
    points[m // 2 :, 0] += 1
    size = points.sum(axis=1).astype(np.int64)
    want = {
        (a, b)
        for a in range(m)
        for b in range(a)
        if 175 * np.minimum(points[a], points[b]).sum() >= 75 * (size[a] + size[b])
    }
    i, j = jaccard_join.RTree(size, points).join()
    assert {(max(a, b), min(a, b)) for a, b in zip(i.tolist(), j.tolist())} == want and len(i) == len(want)
    one, two = points[::3], points[1::3]
    if len(two):
        i, j = jaccard_join.RTree(size[::3], one).join(jaccard_join.RTree(size[1::3], two))
        both = {(a, b) for a in range(len(one)) for b in range(len(two)) if 175 * np.minimum(one[a], two[b]).sum() >= 75 * (size[::3][a] + size[1::3][b])}
        assert set(zip(i.tolist(), j.tolist())) == both


def test_links_do_not_depend_on_the_rest_of_the_table(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(300)]
    base = [[str(rng.choice(words)) for _ in range(60)] for _ in range(8)]
    rows = [(10 * k + j, " ".join(t[:58] + [f"x{j}"] * j + t[58:])) for k, t in enumerate(base) for j in range(4)]
    rest = [(1000 + k, " ".join(rng.choice(words, 400))) for k in range(150)]
    alone = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    among = jaccard_join.jaccard_components(spark.createDataFrame(rows + rest, "doc_id long, text string")).collect()
    key = lambda found: sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found if r.doc_id < 1000)
    assert key(alone) == key(among) == sorted(plain_components(rows))
