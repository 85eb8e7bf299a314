"""The Kneser-Ney model against a plain version, and the classifier on labelled rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sifter.llm import kneser_ney, quality


def plain_model(texts):
    """Interpolated modified Kneser-Ney over byte trigrams, with dicts: (a, b, c) -> probability."""
    three = Counter()
    for t in texts:
        b = b"\n\n" + b" ".join(t.encode().split()) + b"\n"
        three.update(b[i - 2 : i + 1] for i in range(2, len(b)))
    two = Counter(g[1:] for g in three)
    one = Counter(g[1:] for g in two)

    def discount(counts):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d = [(k + 1) - (k + 2) * y * n[k + 1] / n[k] if n[k] else y * (k + 1) for k in range(3)]
        d = [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]
        return lambda c: d[min(c, 3) - 1]

    tables = []
    for counts in (three, two, one):
        cut, total, mass = discount(counts), defaultdict(int), defaultdict(float)
        for g, c in counts.items():
            total[g[:-1]] += c
            mass[g[:-1]] += cut(c)
        tables.append((counts, cut, total, mass))

    def prob(g):
        if not g:
            return 1 / 256
        counts, cut, total, mass = tables[3 - len(g)]
        context = g[:-1]
        if context not in total:
            return prob(g[1:])
        own = counts[g] - cut(counts[g]) if counts[g] else 0.0
        return own / total[context] + mass[context] / total[context] * prob(g[1:])

    return prob


TEXTS = ["the cat sat on the mat", "", "the  the\tcat\nand the dog", "é ü the", "a" * 50]


def test_model_equals_plain_version_and_sums_to_one(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    logs = quality.fit(quality.trigram_counts(df)).full()
    prob = plain_model(TEXTS)
    rng = np.random.default_rng(0)
    grams = [bytes(rng.choice(list(b" \nthecatdog\xc3z"), 3).tolist()) for _ in range(300)]
    for g in grams:
        assert 2.0 ** float(logs[int.from_bytes(g)]) == pytest.approx(prob(g), rel=1e-4)
    sums = np.exp2(logs.reshape(256, 256, 256)[list(b"th \n\xff")][:, list(b"he \nz")].astype(float)).sum(axis=2)
    assert np.allclose(sums, 1, atol=1e-4)


def test_perplexity_of_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(quality, "STEP", 16)
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*TEXTS, None])], "doc_id long, text string")
    model = quality.fit(quality.trigram_counts(df))
    prob = plain_model([*TEXTS, ""])
    for r in quality.perplexities(df, model, ["doc_id"]).collect():
        b = b"\n\n" + b" ".join([*TEXTS, ""][r.doc_id].encode().split()) + b"\n"
        bits = [np.log2(prob(b[i - 2 : i + 1])) for i in range(2, len(b))]
        assert r.n_bytes == len(bits) and r.perplexity == pytest.approx(2 ** -np.mean(bits), rel=1e-3)


def test_labelled_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    rows = [(got[r.doc_id].keep, r.quality) for r in labels.collect()]
    assert np.mean([k for k, q in rows if q == 1]) > 0.97
    assert np.mean([not k for k, q in rows if q == 0]) > 0.85


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(0, 1, "x"), (0, 1, "x"), (5, 0, "x"), (None, 1, "x"), (7, None, "x")], "doc_id long, quality int, text string")
    docs = odd.withColumn("lang", odd["source"])
    got = quality.classify(docs, labels).collect()
    assert len(got) == odd.count() and sum(r.trusted for r in got) == 1
    assert all(r.keep == (r.perplexity <= r.threshold) for r in got)
    assert all(r.keep and r.threshold is None for r in quality.classify(docs, labels.limit(0)).collect())
    assert quality.classify(none.withColumn("lang", none["source"]), labels).count() == 0


def plain_kneser_ney(texts, order):
    """The same model with dicts, of any order: bytes -> probability of the last after the others."""
    tables, top = [], Counter()
    for t in texts:
        b = b"\n" * (order - 1) + b" ".join(t.encode().split()) + b"\n"
        top.update(b[i : i + order] for i in range(len(b) - order + 1))
    for _ in range(order):
        n = [sum(c == k for c in top.values()) for k in (1, 2, 3, 4)]
        d = kneser_ney.modified(n)
        total, mass = Counter(), Counter()
        for g, c in top.items():
            total[g[:-1]] += c
            mass[g[:-1]] += d[min(c, 3) - 1]
        tables.append((top, d, total, mass))
        top = Counter(g[1:] for g in top)

    def prob(g):
        if not g:
            return 1 / 256
        counts, d, total, mass = tables[order - len(g)]
        if g[:-1] not in total:
            return prob(g[1:])
        own = counts[g] - d[min(counts[g], 3) - 1] if counts[g] else 0.0
        return (own + mass[g[:-1]] * prob(g[1:])) / total[g[:-1]]

    return prob


def code_length(prob, text, order):
    b = b"\n" * (order - 1) + b" ".join((text or "").encode().split()) + b"\n"
    return np.mean([-np.log2(prob(b[i : i + order])) for i in range(len(b) - order + 1)])


@pytest.mark.parametrize("block", [1, 100, 1 << 20])
def test_sharded_model_equals_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(kneser_ney, "STEP", 64)
    texts = [*TEXTS, None, *(f"the cat number {k} sat on mat {k % 3}" for k in range(12)), "a dog, unseen é"]
    rows = [(k, "x", t) for k, t in enumerate(texts)] + [(None, None, "the mat"), (3, "x", "the cat sat")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    known = spark.createDataFrame([(k,) for k in range(len(texts) - 3)], "id long")
    got = kneser_ney.perplexities(docs, known, block).collect()
    trusted = [t or "" for i, _, t in rows if i is not None and i < len(texts) - 3]
    apart = {t for t in trusted if zlib.crc32(kneser_ney.body(t)) % kneser_ney.FOLDS == 0}
    assert 0 < len(apart) < len(set(trusted))
    whole = plain_kneser_ney(trusted, kneser_ney.ORDER)
    rest = plain_kneser_ney([t for t in trusted if t not in apart], kneser_ney.ORDER)
    key = lambda i, n, p: (-1 if i is None else i, n, p)
    want = sorted(key(i, len(kneser_ney.body(t)), 2 ** code_length(whole, t, kneser_ney.ORDER)) for i, _, t in rows)
    for (i, n, p), r in zip(want, sorted(got, key=lambda r: key(r.doc_id, r.n_bytes, r.perplexity)), strict=True):
        assert (-1 if r.doc_id is None else r.doc_id, r.n_bytes) == (i, n) and r.perplexity == pytest.approx(p, rel=1e-4)
    unseen = sorted(2 ** code_length(rest, t, kneser_ney.ORDER) for t in trusted if t in apart)
    assert sorted(r.unseen for r in got if r.unseen is not None) == pytest.approx(unseen, rel=1e-4)
    assert sum(r.trusted for r in got) == len(trusted)


def test_probabilities_sum_to_one():
    prob = plain_kneser_ney(TEXTS, kneser_ney.ORDER)
    keys = []
    depth = kneser_ney.DEPTH
    for context in (b"\n\n\nthe"[-depth:], b"e cat sat"[:depth], b"z" * depth, b"a" * depth):
        keys += [int.from_bytes(context[::-1]) << 8 | w for w in range(256)]
        assert sum(prob(context + bytes([w])) for w in range(256)) == pytest.approx(1)
    streams = [kneser_ney.PAD + kneser_ney.body(t) for t in TEXTS]
    grams = [int.from_bytes(b[i : i + depth][::-1]) << 8 | b[i + depth] for b in streams for i in range(len(b) - depth)]
    k, n = kneser_ney.sorted_counts(np.array(grams, np.uint64))
    levels = kneser_ney.by_depth(k, n)
    rows = [{"depth": 1, "place": int(g), "n": int(c)} for g, c in zip(*levels[1])]
    rows += [{"depth": d, "place": c, "n": int((levels[d][1] == c).sum())} for d in range(2, depth + 1) for c in (1, 2, 3, 4)]
    p = np.exp2(kneser_ney.Counts(k, n, *kneser_ney.shared(rows)).log2(np.array(keys, np.uint64))).reshape(4, 256)
    assert np.allclose(p.sum(axis=1), 1)
    assert p[0, ord(" ")] == pytest.approx(prob(b"\n\n\nthe"[-depth:] + b" "))


def test_word_order_is_seen(spark):
    """The words begin and end alike, so byte trigrams say nothing of their order."""
    words = ["stone", "shade", "smile", "snake", "spoke", "state", "scene", "sauce"]
    rng = np.random.default_rng(3)
    good = [" ".join(words[(k + i) % 8] for i in range(n)) for k in range(8) for n in range(30, 60)]
    bad = [" ".join(rng.permutation(g.split()).tolist()) for g in good[::6]]
    rows = [(i, "x", t) for i, t in enumerate(good)] + [(1000 + i, "x", t) for i, t in enumerate(bad)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, len(good), 2)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(got[i].keep for i in range(len(good)))
    assert not any(got[1000 + i].keep for i in range(len(bad)))
