"""Encoding, packing and token blocks against the tokenizers library itself."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sifter.llm import packing, token_blocks, tokens

os.environ["TOKENIZERS_PARALLELISM"] = "false"
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def plain(name, texts, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [[*x.ids, end] for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


TEXTS = ["", " ", "\n", "  a  b", "a \n b", "a\n\nb", "it's don't 'll x", "foo. Bar, x.y a.b. ... !? 3,5 1234",
         "é à İstanbul ΣΑΣ Σ", "é áb", "tab\there \tx", "nbsp\xa0x \xa0 y", "<|endoftext|> a<|endoftext|>b",
         "日本 語。x", "a\r\nb", "x　 y", "\x1c a \x1c", "end ", " start", "a.b.\n.c", "Ünï. ß", "don't. can't, O'Neil's",
         "İ_ a İ! the İ. İx! xİ", "<|ENDOFTEXT|> A<|EndOfText|>B", "Hello <|endoftext|> World. <|startoftext|>!", "<|endoftext|>\n<|endoftext|>"]


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_library(name, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 20)  # starts anew between calls
    enc = tokens.Encoder(public_tokenizers.path(name))
    want = [x[:-1] for x in plain(name, TEXTS, 0)]
    for _ in range(3):
        assert [x.tolist() for x in enc.encode(TEXTS)] == want


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_library_on_random_strings(name, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 300)
    rng = np.random.default_rng(1)
    parts = ["a", "The", "word", "İ", "ß", "Σ", "é", "e\u0301", " ", " ", " ", "\n", "  ", ".", "!", "_", "'s", "'", "1", "漢", "\u0307", "\xa0", "<|endoftext|>", "<|", "|>", "I"]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(0, 14))) for _ in range(4000)]
    enc = tokens.Encoder(public_tokenizers.path(name))
    want = [x[:-1] for x in plain(name, texts, 0)]
    for k in range(0, len(texts), 100):
        assert [x.tolist() for x in enc.encode(texts[k : k + 100])] == want[k : k + 100]


@pytest.mark.parametrize("name", FILES)
def test_only_distinct_words_are_looked_up(name, monkeypatch):
    looked = []
    find = tokens._Codes.__getitem__
    monkeypatch.setattr(tokens._Codes, "__getitem__", lambda self, w: looked.append(w) or find(self, w))
    texts = ["one two three two\none two\nthree one"] * 200
    enc = tokens.Encoder(public_tokenizers.path(name))
    assert [x.tolist() for x in enc.encode(texts)] == [x[:-1] for x in plain(name, texts, 0)]
    assert len(looked) < 2 * len(texts)  # a text's first word, and each distinct word once


def test_segment_round_trip():
    rng = np.random.default_rng(0)
    for _ in range(40):
        ids = [rng.integers(0, rng.choice([1, 2, 100, 50000, 2**32]), rng.integers(0, 700)).astype(np.uint32) for _ in range(rng.integers(0, 8))]
        seg = token_blocks.Segment(token_blocks.write_segment([None, *range(1, len(ids))][: len(ids)], ids))
        flat = np.concatenate([np.zeros(0, np.uint32), *ids])
        assert (seg.ids(0, seg.size) == flat).all() and seg.doc_ids == [None, *range(1, len(ids))][: len(ids)]
        if len(flat) > 10:  # any run is read by itself
            a, b = sorted(rng.integers(0, len(flat), 2))
            assert (seg.ids(a, b) == flat[a:b]).all()


def test_exceptions_are_used():
    ids = [np.array([*range(255), 2**31], np.uint32)]
    seg = token_blocks.Segment(token_blocks.write_segment([1], ids))
    assert seg.width[0] == 8 and seg.count[0] == 1 and (seg.ids(0, 256) == ids[0]).all()


def test_token_blocks(odd, none, monkeypatch):
    path = public_tokenizers.path(FILES[1])
    got = token_blocks.token_blocks(odd, path).collect()
    rows = odd.collect()
    want = sorted((r.doc_id, zlib.crc32(np.array(x, "<u4").tobytes())) for r, x in zip(rows, plain(FILES[1], [r.text for r in rows], 0)) if r.doc_id is not None)
    assert sorted((r.doc_id, zlib.crc32(r.ids)) for r in got if r.doc_id is not None) == want
    assert len(got) == len(rows)
    ordered = sorted(got, key=lambda r: r.start)
    at = 0
    for r in ordered:
        assert r.start == at
        at += len(r.ids) // 4
    names = [r.doc_id for r in ordered]
    assert names == sorted(names, key=lambda i: (i is not None, i))
    assert token_blocks.token_blocks(none, path).count() == 0


def least_cost(place, penalty, size):
    """The recursion of the packing's docstring, over all pairs."""
    best = [0] + [None] * (len(place) - 1)
    for j in range(1, len(place)):
        options = []
        for i in range(j):
            n = place[j] - place[i]
            if n <= size:
                options.append(best[i] + (0 if n & (n - 1) == 0 else size - n))
        best[j] = min(options) + penalty[j] + packing.SEQUENCE
    return best[-1]


def cost(place, penalty, size, cuts):
    total, last = 0, 0
    for j in cuts:
        n = place[j] - place[last]
        total += (0 if n & (n - 1) == 0 else size - n) + penalty[j] + packing.SEQUENCE
        last = j
    return total


def test_cuts_are_optimal():
    rng = np.random.default_rng(5)
    for _ in range(60):
        gaps = rng.integers(1, 30, rng.integers(1, 40))
        place = np.concatenate([[0], np.cumsum(gaps)])
        penalty = rng.choice([0, 8, 64], len(place))
        cuts = packing.plan_cuts(place, penalty, 64)
        assert cuts[-1] == len(place) - 1
        assert cost(place, penalty, 64, cuts) == least_cost(place.tolist(), penalty.tolist(), 64)


@pytest.mark.parametrize("stretch", [500, 1 << 20])
def test_packing(odd, none, monkeypatch, stretch):
    monkeypatch.setattr(packing, "STRETCH", stretch)
    path = public_tokenizers.path(FILES[0])
    pieces = packing.pack(odd, path, end_id=2, size=256).collect()
    rows = odd.collect()
    ids = plain(FILES[0], [r.text for r in rows], 2)
    # texts of one id in turn: pieces cover each id once
    want = sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids)
    assert sum(p.length for p in pieces) == sum(map(len, ids))
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0) and len(p.ids) == 4 * p.length > 0
        sequences[p.sequence_id] = p.offset + p.length
    assert max(sequences.values()) <= 256
    padding = sum(0 if n & (n - 1) == 0 else 256 - n for n in sequences.values())
    assert padding < 0.1 * sum(sequences.values())
    once = [p for p in sorted(pieces, key=lambda p: p.start) if p.doc_id in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12)]
    docs = {}
    for p in once:
        assert p.start == len(docs.get(p.doc_id, b"")) // 4
        docs[p.doc_id] = docs.get(p.doc_id, b"") + p.ids
        assert p.doc_tokens >= p.start + p.length
    assert all(zlib.crc32(x) in want for x in docs.values()) and len(docs) == 12
    assert packing.pack(none, path).count() == 0
