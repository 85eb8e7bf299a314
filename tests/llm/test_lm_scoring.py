"""Context-tree weighting against a direct recursion, and the query's operator against a plain count."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from sifter.llm import ctw, lm_scoring
from sifter.llm.ctw import DEPTH


def stream(docs):
    return np.frombuffer(ctw.PAD + ctw.PAD[1:].join(docs), np.uint8)


def grams_of(docs):
    b = stream(docs)
    g = ctw.grams(b)
    ok, at = np.zeros(len(g), bool), 0
    for d in docs:
        ok[at : at + len(d)] = True
        at += len(d) + DEPTH - 1
    return g[ok]


class Plain:
    """One tree for each bit decision, by recursion over counts in dicts."""

    def __init__(self, docs):
        self.count = Counter()
        for d in docs:
            text = ctw.PAD + d
            for i in range(DEPTH, len(text)):
                for depth in range(DEPTH + 1):
                    for bit in range(8):
                        node = (text[i - depth : i], bit, text[i] >> (8 - bit))
                        self.count[node, text[i] >> (7 - bit) & 1] += 1
        self.children = {}
        for (c, bit, p), _ in self.count:
            if c:
                self.children.setdefault((c[1:], bit, p), set()).add((c, bit, p))

    def pe(self, node):
        z, o = self.count[node, 0], self.count[node, 1]
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1)

    def pw(self, node):
        if len(node[0]) == DEPTH:
            return self.pe(node)
        return np.logaddexp(self.pe(node), sum(self.pw(c) for c in self.children[node])) - math.log(2)

    def prob(self, context, byte):
        total = 0.0
        for bit in range(8):
            p, left, one = byte >> (8 - bit), 1.0, 0.0
            path = [(context[DEPTH - d :], bit, p) for d in range(DEPTH + 1)]
            path = [n for n in path if self.count[n, 0] + self.count[n, 1]]
            for k, node in enumerate(path):
                z, o = self.count[node, 0], self.count[node, 1]
                stop = 1.0 if k == len(path) - 1 else math.exp(self.pe(node) - self.pw(node)) / 2
                one += left * stop * (o + 0.5) / (z + o + 1)
                left *= 1 - stop
            if not path:
                one = 0.5
            total += math.log(one if byte >> (7 - bit) & 1 else 1 - one)
        return total


def test_tree_equals_recursion_and_sums_to_one():
    train = [b"the cat sat on the mat\n", b"the the cat\n", b"\n", "é the cats\n".encode()]
    test = [b"the cat at the mat\n", b"zebra \xff\n"]
    keys, counts = lm_scoring.sorted_counts(grams_of(train))
    tree = ctw.Tree(ctw.levels_of(keys, counts, 0))
    tree.mix()
    plain = Plain(train)
    for d in [*train, *test]:
        got, done = tree.log_prob(grams_of([d]), DEPTH)
        got = np.where(done, got, math.log(0.5)).sum(axis=0)
        text = ctw.PAD + d
        want = [plain.prob(text[i - DEPTH : i], text[i]) for i in range(DEPTH, len(text))]
        assert np.allclose(got, want, atol=1e-9)
    context = b" the "
    all_bytes = ctw.grams(stream([]))
    base = int(grams_of([context + b"c"])[-1]) & ~255
    all_bytes = np.array([base | b for b in range(256)], np.uint64)
    got, done = tree.log_prob(all_bytes, DEPTH)
    assert abs(np.exp(np.where(done, got, math.log(0.5)).sum(axis=0)).sum() - 1) < 1e-9


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.25, 1e3, 1e7])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12)


def test_packed_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (lm_scoring.unpack_keys(lm_scoring.pack_keys(keys)) == keys).all()


@pytest.mark.parametrize("step", [64, 1 << 20])
def test_scores(spark, monkeypatch, step):
    monkeypatch.setattr(lm_scoring, "STEP", step)
    rng = np.random.default_rng(3)
    words = ["alpha", "beta", "Gamma", "d", "épsilon", "x" * 300]
    texts = [" ".join(rng.choice(words, n)) for n in rng.integers(1, 60, 40)]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    rows += [(100, None, "y"), (101, "", None), (102, " \t\r\n ", "z"), (None, "beta\tbeta", "y"), (7, texts[7], "x")]
    got = lm_scoring.lm_score(spark.createDataFrame(rows, "doc_id long, text string, score string")).collect()
    assert len(got) == len(rows)

    def tokens(t):
        lower = "".join(c.lower() if c.isascii() else c for c in t or "")
        return re.findall(r"[^\x20\x09-\x0D]+", lower)

    def is_held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 10 == 0

    train = [tokens(t) for i, t, _ in rows if not is_held(i)]
    count = Counter(w for t in train for w in t) + Counter({"\n": len(train)})
    n, v = sum(count.values()), len(count)
    plain = Plain([" ".join(t).encode() + b"\n" for t in train]) if step == 64 else None
    want = sorted(
        ((i is not None, i), is_held(i), len(tokens(t)) + 1, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*tokens(t), "\n"]), 6))
        for i, t, _ in [(i if i is not None else 0, t, s) for i, t, s in rows if i is not None]
    )
    have = sorted(((True, r.doc_id), r.held_out, r.n_tokens, round(r.base_score, 6)) for r in got if r.doc_id is not None)
    assert have == want
    assert {r.train_tokens for r in got} == {n}
    for r in got:
        assert r.n_known == sum(count[w] > 0 for w in [*tokens(dict((a, b) for a, b, _ in rows)[r.doc_id]), "\n"])
    if plain:
        for r in got[:6]:
            text = ctw.PAD + " ".join(tokens(dict((a, b) for a, b, _ in rows)[r.doc_id])).encode() + b"\n"
            ln = sum(plain.prob(text[i - DEPTH : i], text[i]) for i in range(DEPTH, len(text)))
            assert abs(r.score - ln / math.log(10)) < 1e-3 * max(1, abs(r.score))


def test_no_documents(spark):
    assert lm_scoring.lm_score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def as_block(texts):
    bodies = [lm_scoring.normalise(t) for t in texts]
    stream = ctw.PAD + ctw.PAD[1:].join(bodies)
    lengths = np.array([len(b) for b in bodies], "<i8")
    return lm_scoring.Block(zstandard.ZstdCompressor().compress(stream), lengths.tobytes(), bytes(len(bodies)))


def test_words_of_two_letters_have_hashes_of_their_own():
    """A Thue-Morse word and its complement, which every polynomial modulo a power of two confuses."""
    words = []
    for n in (10, 11, 12, 13):
        word = "".join("ab"[k.bit_count() % 2] for k in range(1 << n))
        words += [word, word.translate(str.maketrans("ab", "ba"))]
    words += ["ab", "ba", "a", "aa", "abc", "acb", "cab"]
    block = as_block([" ".join(words)])
    hashes = np.concatenate([h for h, _ in block.words()][:-1])
    assert len(hashes) == len(words) == len(set(hashes.tolist()))
    again = as_block(["x " + " ".join(words[::-1])])
    assert sorted(hashes.tolist()) == sorted(np.concatenate([h for h, _ in again.words()][:-1]).tolist()[1:])
