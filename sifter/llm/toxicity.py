"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own vector (words seen often enough in the labelled sample) beside the mean
of its character trigrams' vectors (every word). A forward and a backward GRU run over a window of
words, attention weighs their states, and a logistic unit scores the pooled state. All overlapping
windows of a text are scored, the highest logit is the text's, and a logistic curve fitted to the
labels' true shares turns it into a probability.

Only the fit is bounded: MAX_TOXIC and MAX_CLEAN labelled texts of at most MAX_FIT_CHARS
characters (MAX_SAMPLE_CHARS in all), those with the smallest hash of their id, are learned from; a
positive text teaches
through its most suspicious window. Scoring runs over every text in Arrow batches; the model, sent
to the executors, has a fixed size.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import give_back, quoted
from .tokens import slices

#: Bounds of the labelled sample.
MAX_TOXIC, MAX_CLEAN, MAX_FIT_CHARS, MAX_SAMPLE_CHARS = 1500, 3000, 100_000, 48_000_000
#: A text is rejected at this probability, by the operator and by the pipeline's stage.
THRESHOLD = 0.3
#: Words of a window, and between the starts of windows.
WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 8, 8, 8
GRAMS = 1 << 13
#: Words with vectors of their own: in at least so many sample texts, and so many at most.
MIN_TEXTS, MAX_WORDS = 4, 20_000
#: Passes over the sample, at least, and steps, at least; texts of a step, rate and decay.
EPOCHS, STEPS, BATCH, RATE, DECAY = 4, 400, 128, 0.01, 0.02
#: Pieces a scorer keeps before it starts anew.
MAX_KEPT = 300_000
_STRIP = ".,;:!?\"'()[]{}<>*_-"


def stem(piece: str) -> str:
    return piece.lower().strip(_STRIP)


def grams_of(stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers of all stems in a row, and the place where each stem's begin."""
    data = [b"^" + s.encode() + b"$$" for s in stems]
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    length = np.array([len(x) for x in data], np.int64)
    begin = np.cumsum(length) - length
    code = np.zeros(len(flat), np.uint32)
    code[:-2] = flat[:-2] * np.uint32(961) + flat[1:-1] * np.uint32(31) + flat[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(19)
    inside = np.ones(len(flat), bool)
    inside[begin + length - 1] = inside[begin + length - 2] = False
    return code[inside].astype(np.int64), begin - 2 * np.arange(len(stems))


def means(table: np.ndarray, grams: np.ndarray, begin: np.ndarray, size: int = 20_000) -> np.ndarray:
    """Mean vector of each stem's trigrams, some stems at a time."""
    out = np.empty((len(begin), table.shape[1]), np.float32)
    ends = np.append(begin[1:], len(grams))
    for a in range(0, len(begin), size):
        b = min(a + size, len(begin))
        part = table[grams[begin[a] : ends[b - 1]]]
        out[a:b] = np.add.reduceat(part, begin[a:b] - begin[a], axis=0) / (ends[a:b] - begin[a:b])[:, None].astype(np.float32)
    return out


def windows_of(codes: list[int]) -> np.ndarray:
    """All windows of a text: full ones every STRIDE words and at the end; code 0 fills short texts."""
    if len(codes) <= WINDOW:
        return np.array([codes + [0] * (WINDOW - len(codes))], np.int32)
    last = len(codes) - WINDOW
    starts = np.append(np.arange(0, last, STRIDE), last)
    return np.array(codes, np.int32)[starts[:, None] + np.arange(WINDOW)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def gru(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (B, T, H) over inputs (B, T, D). ``keep`` collects what the backward pass needs."""
    rows, steps, _ = x.shape
    h = np.zeros((rows, HIDDEN), np.float32)
    out = np.empty((rows, steps, HIDDEN), np.float32)
    for t in range(steps):
        a = x[:, t] @ w + b
        c = h @ u
        gates = sigmoid(a[:, : 2 * HIDDEN] + c[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(a[:, 2 * HIDDEN :] + r * c[:, 2 * HIDDEN :])
        if keep is not None:
            keep.append((h, z, r, n, c[:, 2 * HIDDEN :]))
        h = n + z * (h - n)
        out[:, t] = h
    return out


def gru_back(x, w, u, keep, d_out):
    """Gradients of (x, w, u, b) given those of the states."""
    dx, dw, du, db = np.zeros_like(x), np.zeros_like(w), np.zeros_like(u), np.zeros(3 * HIDDEN, np.float32)
    carry = np.zeros_like(d_out[:, 0])
    for t in range(x.shape[1] - 1, -1, -1):
        h, z, r, n, c = keep[t]
        d = d_out[:, t] + carry
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * c * r * (1 - r)
        da = np.concatenate([dz, dr, dn], axis=1)
        dc = np.concatenate([dz, dr, dn * r], axis=1)
        dx[:, t] = da @ w.T
        dw += x[:, t].T @ da
        du += h.T @ dc
        db += da.sum(axis=0)
        carry = d * z + dc @ u.T
    return dx, dw, du, db


def logits(x: np.ndarray, p: dict, keep: dict | None = None) -> np.ndarray:
    """Logit of each window (B, T, D)."""
    fore, back = ([], []) if keep is not None else (None, None)
    hf = gru(x, p["wf"], p["uf"], p["bf"], fore)
    hb = gru(x[:, ::-1], p["wb"], p["ub"], p["bb"], back)[:, ::-1]
    h = np.concatenate([hf, hb], axis=2)
    s = np.tanh(h @ p["wa"])
    e = s @ p["va"]
    e = np.exp(e - e.max(axis=1, keepdims=True))
    a = e / e.sum(axis=1, keepdims=True)
    pooled = np.einsum("bt,bth->bh", a, h)
    if keep is not None:
        keep.update(fore=fore, back=back, h=h, s=s, a=a, pooled=pooled)
    return pooled @ p["out"] + p["bias"][0]


def gradients(x: np.ndarray, y: np.ndarray, p: dict) -> tuple[dict, np.ndarray]:
    keep: dict = {}
    d = (sigmoid(logits(x, p, keep)) - y).astype(np.float32) / len(y)
    h, s, a, pooled = keep["h"], keep["s"], keep["a"], keep["pooled"]
    g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
    dpool = d[:, None] * p["out"]
    da = np.einsum("bh,bth->bt", dpool, h)
    de = a * (da - (a * da).sum(axis=1, keepdims=True))
    g["va"] = np.einsum("bt,bth->h", de, s)
    ds = de[:, :, None] * p["va"] * (1 - s * s)
    g["wa"] = np.einsum("bti,btj->ij", h, ds)
    dh = a[:, :, None] * dpool[:, None] + ds @ p["wa"].T
    dxf, g["wf"], g["uf"], g["bf"] = gru_back(x, p["wf"], p["uf"], keep["fore"], dh[:, :, :HIDDEN])
    back = dh[:, ::-1, HIDDEN:]
    dxb, g["wb"], g["ub"], g["bb"] = gru_back(x[:, ::-1], p["wb"], p["ub"], keep["back"], back)
    return g, dxf + dxb[:, ::-1]


class Lexicon:
    """Codes of pieces and their input vectors; code 0 is padding."""

    def __init__(self, words: dict[str, int], word_table: np.ndarray, gram_table: np.ndarray):
        self.words, self.word_table, self.gram_table = words, word_table, gram_table
        self.reset()

    def reset(self) -> None:
        lexicon = self

        class Codes(dict):
            def __missing__(self, piece):
                self[piece] = code = len(lexicon.pieces)
                lexicon.pieces.append(piece)
                return code

        self.pieces: list[str] = [""]
        self.codes = Codes()
        self.vectors = np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)

    def encode(self, text: str) -> list[int]:
        return list(map(self.codes.__getitem__, text.split()))

    def inputs(self) -> np.ndarray:
        """Vectors of all codes so far."""
        new = [stem(x) for x in self.pieces[len(self.vectors) :]]
        if new:
            grams, begin = grams_of(new)
            chars = means(self.gram_table, grams, begin)
            own = self.word_table[np.array([self.words.get(x, 0) for x in new])]
            self.vectors = np.concatenate([self.vectors, np.concatenate([own, chars], axis=1)])
        return self.vectors


def score_windows(windows: np.ndarray, vectors: np.ndarray, p: dict) -> np.ndarray:
    out = [logits(vectors[windows[k : k + 1024]], p) for k in range(0, len(windows), 1024)]
    return np.concatenate(out)


def fit(texts: list[str], labels: np.ndarray, toxic_share: float, seed: int = 7) -> dict:
    """The model from labelled texts; ``toxic_share`` is the label's share among all labelled rows."""
    rng = np.random.default_rng(seed)
    lexicon = Lexicon({}, np.zeros((1, WORD_DIM)), np.zeros((GRAMS, CHAR_DIM)))
    coded = [np.array(lexicon.encode(t), np.int32) for t in texts]
    stems = [stem(x) for x in lexicon.pieces]
    lexicon.reset()
    numbers: dict[str, int] = {}
    kind = np.array([numbers.setdefault(x, len(numbers)) for x in stems], np.int32)  # of each piece its stem
    grams, gram_begin = grams_of(stems)
    del stems
    gram_count = np.diff(np.append(gram_begin, len(grams)))
    grams = grams.astype(np.int16)
    seen, hits = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    for codes, y in zip(coded, labels):
        own = np.unique(kind[codes])
        seen[own] += 1
        if y:
            hits[own] += 1
    often = [(-int(seen[k]), w, k) for w, k in numbers.items() if seen[k] >= MIN_TEXTS and w]
    common = sorted((w, k) for _, w, k in sorted(often)[:MAX_WORDS])
    words = {w: k + 1 for k, (w, _) in enumerate(common)}
    place = np.zeros(len(numbers), np.int64)
    place[[k for _, k in common]] = np.arange(1, len(common) + 1)
    own = place[kind]
    del numbers, often
    per_text = [windows_of(codes.tolist()) for codes in coded]
    del coded
    # word vectors begin with the log odds of the label; the rest is noise
    positives = max(1, int(labels.sum()))
    negatives = max(1, len(labels) - positives)
    odds = np.zeros(len(words) + 1, np.float32)
    known = [k for _, k in common]
    odds[1:] = np.log((hits[known] + 0.5) / (positives + 1)) - np.log((seen[known] - hits[known] + 0.5) / (negatives + 1))

    def noise(*shape, scale=0.1):
        return (rng.normal(size=shape) * scale).astype(np.float32)

    dim = WORD_DIM + CHAR_DIM
    p = {"words": noise(len(words) + 1, WORD_DIM), "grams": noise(GRAMS, CHAR_DIM)}
    p["words"][0] = 0
    p["words"][:, 0] = np.clip(odds / 4, -1, 1)
    for way in "fb":
        p["w" + way], p["u" + way] = noise(dim, 3 * HIDDEN, scale=0.3), noise(HIDDEN, 3 * HIDDEN, scale=0.3)
        p["b" + way] = np.zeros(3 * HIDDEN, np.float32)
    p |= {"wa": noise(2 * HIDDEN, ATTENTION, scale=0.3), "va": noise(ATTENTION, scale=0.3)}
    p |= {"out": noise(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}

    windows = np.concatenate([np.zeros((0, WINDOW), np.int32), *per_text])
    owner = np.repeat(np.arange(len(texts)), [len(ws) for ws in per_text])
    begin = np.searchsorted(owner, np.arange(len(texts)))
    del per_text

    def vectors() -> np.ndarray:
        table = np.concatenate([p["words"][own], means(p["grams"], grams, gram_begin)], axis=1)
        table[0] = 0
        return table

    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    per_pass = -(-(len(texts) + int((labels == 0).sum())) // BATCH)
    for epoch in range(max(EPOCHS, -(-STEPS // per_pass)) if len(texts) else 0):
        x = vectors()
        if epoch:
            suspicion = score_windows(windows, x, p)
        else:
            suspicion = odds[own][windows].max(axis=1)
        # a text teaches through its most suspicious window; a clean one through a random one too
        order = np.lexsort((suspicion, owner))
        top = order[np.append(begin[1:], len(owner)) - 1]
        free = begin + (rng.random(len(texts)) * np.diff(np.append(begin, len(owner)))).astype(np.int64)
        chosen = np.concatenate([top, free[labels == 0]])
        target = labels[owner[chosen]].astype(np.float32)
        for part in np.array_split(rng.permutation(len(chosen)), -(-len(chosen) // BATCH)):
            codes, inverse = np.unique(windows[chosen[part]], return_inverse=True)
            flat = gram_count[codes]
            at = np.repeat(gram_begin[codes] - (np.cumsum(flat) - flat), flat) + np.arange(flat.sum())
            chars = np.add.reduceat(p["grams"][grams[at]], np.cumsum(flat) - flat, axis=0) / flat[:, None]
            table = np.concatenate([p["words"][own[codes]], chars.astype(np.float32)], axis=1)
            table[codes == 0] = 0
            inverse = inverse.reshape(-1, WINDOW)
            g, dx = gradients(table[inverse], target[part], p)
            d = np.zeros_like(table)
            np.add.at(d, inverse.ravel(), dx.reshape(-1, dim))
            d[codes == 0] = 0
            g["words"], g["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
            np.add.at(g["words"], own[codes], d[:, :WORD_DIM])
            g["words"][0] = 0
            np.add.at(g["grams"], grams[at], np.repeat(d[:, WORD_DIM:] / flat[:, None], flat, axis=0))
            step += 1
            for k in p:  # Adam
                m, v = moment[k]
                m += 0.1 * (g[k] - m)
                v += 0.001 * (g[k] * g[k] - v)
                p[k] = p[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                if k in ("words", "grams"):
                    p[k] = p[k] * (1 - RATE * DECAY)
                p[k] = p[k].astype(np.float32)
    model = {"words": words, "params": p, "curve": (1.0, 0.0)}
    if len(texts):
        highest = np.maximum.reduceat(score_windows(windows, vectors(), p), begin)
        share = positives / len(labels)
        weight = np.where(labels == 1, toxic_share / share, (1 - toxic_share) / max(1e-9, 1 - share))
        model["curve"] = platt(highest.astype(np.float64), labels.astype(np.float64), weight)
    return model


def platt(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic curve a * x + b by Newton steps, slightly pulled to (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(weight * (q - y) * x).sum() + (a - 1), (weight * (q - y)).sum() + b])
        s = weight * q * (1 - q)
        hess = np.array([[(s * x * x).sum() + 1, (s * x).sum()], [(s * x).sum(), s.sum() + 1]])
        move = np.linalg.solve(hess, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return max(float(a), 1e-3), float(b)


def learn(docs: DataFrame, labels: DataFrame, train: str, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> dict:
    """Fit on the bounded sample of labelled rows that meet ``train`` (an SQL condition on labels).

    The fit is one task of an executor; the driver gets the finished model alone, whose size is
    bounded by MAX_WORDS and GRAMS. Rows with a null id or label are left out; of equal texts one is
    used, as toxic if any of its labels is. Without toxic or without clean rows the model says the
    share of toxic labels, or 0, for every text.
    """
    known = labels.where(train).where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull())
    known = known.select(F.col(doc_id).alias("id"), (F.col(toxic) > 0).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    flat = {"words": {}, "params": None, "share": share}
    if len(counts) < 2:
        return flat
    pick = None
    for y, n in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
        pick = part if pick is None else pick.unionByName(part)
    # at most MAX_TOXIC + MAX_CLEAN ids
    body = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    body = body.where(F.length("text") <= MAX_FIT_CHARS)
    sample = body.join(F.broadcast(pick), "id").groupBy("text").agg(F.max("y").alias("y"))
    order = (F.xxhash64("text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        marks: list[int] = []
        left = MAX_SAMPLE_CHARS
        for batch in batches:
            for body, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                left -= len(body)
                if left >= 0:
                    texts.append(body)
                    marks.append(y)
        model = fit(texts, np.array(marks), share) if len(set(marks)) == 2 else flat
        texts.clear()
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    fitted = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else flat


def score_texts(docs: DataFrame, model: dict, keep: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``out``: the probability (0 to 1) that the text is toxic, by
    all its windows. A null text counts as empty; an empty one is a window of padding and has a score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        p = m["params"]
        lexicon = Lexicon(m["words"], p["words"], p["grams"]) if p else None
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for a, b, texts in slices(batch.column("text")):
                if not p:
                    scores[a:b] = m["share"]
                    continue
                if len(lexicon.pieces) > MAX_KEPT:
                    lexicon.reset()
                per_text = [windows_of(lexicon.encode(t)) for t in texts]
                begin = np.cumsum([0, *map(len, per_text)])[:-1]
                best = score_windows(np.concatenate(per_text), lexicon.inputs(), p)
                best = np.maximum.reduceat(best, begin).astype(np.float64)
                slope, base = m["curve"]
                scores[a:b] = 1 / (1 + np.exp(-np.clip(slope * best + base, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(scores)], names=["kept", "score"])

    kept = StructType([docs.schema[n] for n in keep])
    rows = docs.select(F.struct(*map(quoted, keep)).alias("kept"), quoted(text).alias("text"))
    scored = rows.mapInArrow(run, StructType([StructField("kept", kept), StructField("score", DoubleType())]))
    return scored.select("kept.*", F.col("score").alias(out))


def toxicity(
    docs: DataFrame, labels: DataFrame, held: str = "pmod(crc32(cast(doc_id as string)), 4) = 2", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. ``held`` is an SQL condition
    on doc_id; labels of rows that meet it are never learned from. Null ids are not held out. Rows
    that repeat are scored alike; other columns are ignored; an empty table gives no rows."""
    model = learn(docs, labels, f"NOT coalesce({held}, false)")
    return score_texts(docs, model, ["doc_id"]).select(
        "doc_id",
        F.coalesce(F.expr(held), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
