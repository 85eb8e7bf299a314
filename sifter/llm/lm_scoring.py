"""LM scoring: code lengths by context-tree weighting, learned from the corpus by exchange.

1. Documents are lower-cased, their words joined by single spaces and ended by a line break, and
   gathered in compressed *blocks* of about BLOCK bytes (no shuffle: a block is part of an input
   partition).
2. Each block sends its distinct grams (and word hashes) with their counts in training documents to
   owners, dealt by the two nearest context bytes, sorted and packed. Owners sum them and weigh
   their part of the context tree; the sums over their parts make the nodes of depths 0 and 1, of
   which there are 65,535 at most.
3. Blocks ask the owners for the code lengths of just the grams they hold, and add them up.

So the model is never in one place, what is exchanged grows with the corpus, and a block's memory
depends on its size only. Owners merge what blocks send one after the other: their memory depends on
the distinct grams they own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ctw
from .common import materialise
from .ctw import DEPTH, Level, Tree

#: Bytes of a block, and places worked on at a time.
BLOCK, STEP = 16 << 20, 1 << 20
#: Context depth from which trees lie with owners.
SPLIT = 2
MAX_OWNERS = 1024
GRAM, WORD = 0, 1
#: The key of a document's end among word hashes.
END = np.uint64(0x9E3779B97F4A7C15)


# ---- packed arrays


def squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes())


def expand(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, "<u8"), dtype=np.uint64)


# ---- blocks


def normalise(text: str) -> bytes:
    return b" ".join(text.encode("utf-8", "replace").lower().split()) + b"\n"


class Block:
    """A block read back: the byte stream and, of each document, its first place and length."""

    def __init__(self, body: bytes, length: bytes, held: bytes):
        self.stream = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
        self.length = np.frombuffer(length, "<i8")
        self.begin = DEPTH + np.cumsum(self.length + DEPTH - 1) - (self.length + DEPTH - 1)
        self.held = np.frombuffer(held, np.uint8).astype(bool)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, places, side="right") - 1

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(grams, documents) of all places that count, in runs."""
        for a in range(DEPTH, len(self.stream), STEP):
            b = min(a + STEP, len(self.stream))
            doc = self.document(np.arange(a, b))
            inside = np.arange(a, b) < self.begin[doc] + self.length[doc]
            yield ctw.grams(self.stream[a - DEPTH : b])[inside], doc[inside]

    def words(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(64-bit hashes, documents) of all words and ends, in runs that do not cut words (so
        memory grows with the longest word)."""
        gap = (self.stream == 32) | (self.stream == 10)
        a = DEPTH
        while a < len(self.stream):
            b = min(a + STEP, len(self.stream))
            while b < len(self.stream) and not gap[b - 1]:
                b += 1 + int(np.argmax(gap[b : b + STEP])) if gap[b : b + STEP].any() else len(gap[b : b + STEP])
            part, apart = self.stream[a:b], np.concatenate([[True], gap[a:b], [True]])
            first, last = np.flatnonzero(apart[:-1] & ~apart[1:]), np.flatnonzero(~apart[:-1] & apart[1:])
            # a word's hash adds up those of its (byte, place) pairs: no algebra ties pairs of words together
            size = last - first
            letters = part[~apart[1:-1]].astype(np.uint64)
            z = np.arange(len(letters), dtype=np.uint64) - np.repeat((np.cumsum(size) - size).astype(np.uint64), size)
            z *= np.uint64(0x9E3779B97F4A7C15)
            z += (letters + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
            z ^= z >> np.uint64(30)
            z *= np.uint64(0xBF58476D1CE4E5B9)
            z ^= z >> np.uint64(27)
            z *= np.uint64(0x94D049BB133111EB)
            z ^= z >> np.uint64(31)
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(z, dtype=np.uint64)])
            ends = np.cumsum(size)
            h = upto[ends] - upto[ends - size]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(29)
            yield h, self.document(first + a)
            a = b
        yield np.full(len(self.length), END, np.uint64), np.arange(len(self.length))

    def parts(self, kind: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return self.grams() if kind == GRAM else self.words()

    def distinct(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys and their counts in documents that are not held out."""
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for k, doc in self.parts(kind):
            held = self.held[doc]
            own, n = sorted_counts(k[~held])
            out, _ = sorted_counts(k[held])
            keys, counts = ctw.merge(
                np.concatenate([keys, own, out]), np.concatenate([counts, n, np.zeros(len(out), np.int64)])
            )
        return keys, counts


def sorted_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def owner_of(keys: np.ndarray, kind: int, owners: int) -> np.ndarray:
    if kind == GRAM:  # by the two nearest context bytes
        pair = (keys >> np.uint64(8 * (DEPTH + 1 - SPLIT))) * np.uint64(0x9E3779B97F4A7C15)
        return ((pair >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    return ((keys >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


def by_owner(keys: np.ndarray, kind: int, owners: int) -> list[np.ndarray]:
    """For each owner the places of its keys, ascending."""
    own = owner_of(keys, kind, owners)
    order = np.argsort(own, kind="stable")
    return np.split(order, np.searchsorted(own[order], np.arange(1, owners)))


# ---- the Spark jobs


def make_blocks(docs: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """``docs``: (doc_id, held, text). A block has about ``block_bytes`` and at most 2**20 documents. Blocks: (block, doc_ids, missing, body, length, held)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 20
        ids, held, bodies, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            length = np.array([len(b) for b in bodies], "<i8")
            stream = ctw.PAD + ctw.PAD[1:].join(bodies)
            body = zstandard.ZstdCompressor(level=1).compress(stream)
            number = np.array([i or 0 for i in ids], "<i8").tobytes()
            missing = np.array([i is None for i in ids], np.uint8).tobytes()
            row = [number, missing, body, length.tobytes(), np.array(held, np.uint8).tobytes()]
            columns = [pa.array([block], pa.int64()), *(pa.array([x], pa.binary()) for x in row)]
            return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "missing", "body", "length", "held"])

        for batch in batches:
            for name, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held", "text"))):
                ids.append(name)
                held.append(out)
                bodies.append(normalise(text or ""))
                size += len(bodies[-1])
                if size >= block_bytes or len(ids) >= 1 << 20:
                    yield flush()
                    block, ids, held, bodies, size = block + 1, [], [], [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, "block long, doc_ids binary, missing binary, body binary, length binary, held binary")


_SENT = "owner long, kind int, block long, keys binary, counts binary"


def send(blocks: DataFrame, owners: int, counted: bool) -> DataFrame:
    """What each block sends to each owner: its keys, with counts or (asking) without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body, length, held in zip(*(batch.column(c).to_pylist() for c in ("block", "body", "length", "held"))):
                block = Block(body, length, held)
                for kind in (GRAM, WORD):
                    keys, counts = block.distinct(kind)
                    rows = []
                    for owner, at in enumerate(by_owner(keys, kind, owners)):
                        if counted:
                            at = at[counts[at] > 0]
                        if len(at):
                            rows.append((owner, kind, name, pack_keys(keys[at]), squeeze(counts[at].astype("<i8")) if counted else None))
                    if rows:
                        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["owner", "kind", "block", "keys", "counts"])

    return blocks.select("block", "body", "length", "held").mapInArrow(run, _SENT)


def top_rows(tree: Tree) -> tuple[np.ndarray, ...]:
    """An owner's share of the depth-1 nodes: key with its bit, zeros, ones, log Pw of the children."""
    out = []
    for bit in range(8):
        level, (keys, pw) = tree.levels[bit][SPLIT], tree.pw_top[bit]
        nodes, at = np.unique(up1 := ctw.up(keys, bit), return_inverse=True)
        assert len(up1) == len(level.keys)
        sums = [np.bincount(at, weights=x, minlength=len(nodes)) for x in (level.zeros, level.ones, pw)]
        out.append((nodes.astype(np.int64) * 8 + bit, sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2]))
    return tuple(np.concatenate(x) for x in zip(*out))


_STATE = "owner long, kind int, keys binary, counts binary, node long, zeros long, ones long, pw double"


def gather(sent: DataFrame, owners: int) -> DataFrame:
    """Owners' sums: a row of (keys, counts) for each owner and kind, and rows of its depth-1 nodes.
    Of word rows ``zeros`` holds all tokens and ``ones`` the distinct ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, counts = None, [], []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return ctw.merge(np.concatenate(keys), np.concatenate(counts))

        def flush() -> Iterator[pd.DataFrame]:
            k, n = merged()
            owner, kind = current
            row = {"owner": [owner], "kind": [kind], "keys": [pack_keys(k)], "counts": [squeeze(n.astype("<i8"))]}
            row |= {"node": [None], "zeros": [int(n.sum())], "ones": [len(k)], "pw": [None]}
            yield row
            if kind == GRAM:
                node, zeros, ones, pw = top_rows(Tree(ctw.levels_of(k, n, SPLIT)))
                rest = len(node)
                yield {"owner": [owner] * rest, "kind": [2] * rest, "keys": [None] * rest, "counts": [None] * rest} | {
                    "node": node, "zeros": zeros, "ones": ones, "pw": pw
                }

        schema = pa.schema([("owner", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("node", pa.int64()), ("zeros", pa.int64()), ("ones", pa.int64()), ("pw", pa.float64())])
        for batch in batches:
            for owner, kind, k, n in zip(*(batch.column(c).to_pylist() for c in ("owner", "kind", "keys", "counts"))):
                if (owner, kind) != current:
                    if current:
                        for x in flush():
                            yield pa.RecordBatch.from_pydict(x, schema=schema)
                    current, keys, counts = (owner, kind), [], []
                keys.append(unpack_keys(k))
                counts.append(expand(n, "<i8"))
                if len(keys) >= 8:  # sums replace what they add up
                    keys, counts = ([x] for x in merged())
        if current:
            for x in flush():
                yield pa.RecordBatch.from_pydict(x, schema=schema)

    parts = min(owners, 4 * max(1, int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return sent.repartition(parts, "owner").sortWithinPartitions("owner", "kind").mapInArrow(run, _STATE)


def top_tree(rows: list) -> Tree:
    """Depths 0 and 1 from the sums over the owners."""
    levels, below = [], []
    for bit in range(8):
        own = sorted((r["node"] >> 3, r["zeros"], r["ones"], r["pw"]) for r in rows if r["node"] & 7 == bit)
        keys, zeros, ones, pw = (np.array([r[k] for r in own], t) for k, t in enumerate((np.uint64, np.int64, np.int64, float)))
        nodes, at = np.unique(ctw.up(keys, bit), return_inverse=True)
        sums = [np.bincount(at, weights=x, minlength=len(nodes)).astype(np.int64) for x in (zeros, ones)]
        levels.append({0: Level.of(nodes, *sums), 1: Level.of(keys, zeros, ones)})
        below.append((keys, pw))
    # the children's sums are already by depth-1 node: a level below with the parents' own keys
    tree = Tree.__new__(Tree)
    tree.levels, tree.depths, tree.stop, tree.pw_top = levels, [0, 1], [], []
    for bit in range(8):
        one = levels[bit][1]
        pe = ctw.log_pe(one.zeros, one.ones)
        pw = np.logaddexp(pe, below[bit][1]) - np.log(2)
        pw0, stop0 = ctw.weigh(levels[bit][0], (one.keys, pw), bit)
        tree.stop.append({0: stop0, 1: np.exp(pe - pw) / 2})
        tree.pw_top.append((levels[bit][0].keys, pw0))
    tree.mix()
    return tree


def answer(asked: DataFrame, state: DataFrame, top, owners: int) -> DataFrame:
    """(block, owner, kind, values): for grams ln of the probability, for words the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shallow, current = top.value, None
        known, counts, tree, value = np.zeros(0, np.uint64), np.zeros(0, np.int64), None, None
        for batch in batches:
            out = []
            for owner, kind, block, k, n in zip(*(batch.column(c).to_pylist() for c in ("owner", "kind", "block", "keys", "counts"))):
                if (owner, kind) != current:
                    current = owner, kind
                    known, counts, tree, value = np.zeros(0, np.uint64), np.zeros(0, np.int64), None, None
                if block is None:  # the owner's sums come first
                    known, counts = unpack_keys(k), expand(n, "<i8")
                    continue
                keys = unpack_keys(k)
                if kind == GRAM:
                    if tree is None:
                        tree = Tree(ctw.levels_of(known, counts, SPLIT))
                        tree.mix(shallow.under)
                        value = gram_values(tree, shallow, known)
                    at, hit = lookup(known, keys)
                    values = np.zeros(len(keys), np.float32)
                    values[hit] = value[at[hit]]
                    values[~hit] = gram_values(tree, shallow, keys[~hit])
                else:
                    at, hit = lookup(known, keys)
                    values = np.zeros(len(keys), np.int64)
                    values[hit] = counts[at[hit]]
                out.append((block, owner, kind, squeeze(values)))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["block", "owner", "kind", "values"])

    sums = state.where("kind < 2").select("owner", "kind", F.lit(None).cast("long").alias("block"), "keys", "counts")
    parts = min(owners, 4 * max(1, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = sums.unionByName(asked).repartition(parts, "owner")
    rows = rows.sortWithinPartitions("owner", "kind", F.col("block").asc_nulls_first())
    return rows.mapInArrow(run, "block long, owner long, kind int, values binary")


def lookup(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def gram_values(tree: Tree, shallow: Tree, keys: np.ndarray) -> np.ndarray:
    """ln probability of grams: bits whose node the owner lacks come from depths 1 and 0, and bits
    nobody has seen are even."""
    out, done = tree.log_prob(keys, DEPTH)
    if not done.all():
        more, found = shallow.log_prob(keys, DEPTH)
        out = np.where(done, out, np.where(found, more, np.log(0.5)))
    return out.sum(axis=0)


def score_blocks(blocks: DataFrame, answers: DataFrame, owners: int, tokens: int, distinct: int) -> DataFrame:
    """Per document: doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score."""

    def values_of(block: Block, kind: int, rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        keys, _ = block.distinct(kind)
        values = np.zeros(len(keys), np.float32 if kind == GRAM else np.int64)
        places = by_owner(keys, kind, owners)
        for owner, got in zip(rows["owner"], rows["values"]):
            values[places[owner]] = expand(got, "<f4" if kind == GRAM else "<i8")
        return keys, values

    def run(blob: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for row in blob.itertuples():
            block = Block(row.body, row.length, row.held)
            n = len(block.length)
            sums = {c: np.zeros(n) for c in ("n_tokens", "n_known", "base", "score")}
            for kind in (GRAM, WORD):
                keys, values = values_of(block, kind, answered[answered["kind"] == kind])
                for k, doc in block.parts(kind):
                    order = np.argsort(k)
                    ordered = k[order]
                    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(k) else np.zeros(0, np.int64)
                    found = values[np.searchsorted(keys, ordered[first])]
                    got = np.empty(len(k), values.dtype)
                    got[order] = np.repeat(found, np.diff(np.append(first, len(k))))
                    if kind == GRAM:
                        sums["score"] += np.bincount(doc, weights=got, minlength=n)
                    else:
                        sums["n_tokens"] += np.bincount(doc, minlength=n)
                        sums["n_known"] += np.bincount(doc, weights=got > 0, minlength=n)
                        share = np.log10((got + 0.1) / (tokens + 0.1 * (distinct + 1)))
                        sums["base"] += np.bincount(doc, weights=share, minlength=n)
            frames.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.arrays.IntegerArray(np.frombuffer(row.doc_ids, "<i8").copy(), np.frombuffer(row.missing, np.uint8).astype(bool)),
                        "held_out": block.held,
                        "n_bytes": block.length,
                        "n_tokens": sums["n_tokens"].astype(np.int64),
                        "n_known": sums["n_known"].astype(np.int64),
                        "train_tokens": tokens,
                        "base_score": sums["base"],
                        "score": sums["score"] / np.log(10),
                    }
                )
            )
        return pd.concat(frames) if frames else pd.DataFrame(columns=names)

    names = ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = "doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, schema)


def lm_score(
    docs: DataFrame,
    held: str = "pmod(crc32(cast(doc_id as string)), 10) = 0",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte.

    Texts are lower-cased (A-Z) and read as words `[^\\x20\\x09-\\x0D]+` and one end; score is the
    model's log10 probability of that sequence, its bytes with single spaces between words and a
    line break at the end (n_bytes in all); base_score that of single words with 0.1 added to each
    count. Rows that meet ``held`` (an SQL condition on doc_id) are scored but not learned from;
    null ids are not held out; null texts are empty: one end. Repeated rows count each. An empty
    table gives no rows; without training rows every bit has probability 1/2.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", F.coalesce(F.expr(held), F.lit(False)).alias("held"), "text")
    blocks = materialise(make_blocks(rows), "lm-blocks")
    owners = min(MAX_OWNERS, max(16, blocks.count()))
    state = materialise(gather(send(blocks, owners, True), owners), "lm-state")
    totals = state.where(F.col("kind") == WORD).agg(F.sum("zeros").alias("n"), F.sum("ones").alias("v")).first()
    # at most 255 contexts and decisions each: 65,025 rows
    nodes = state.where("kind = 2").groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("pw").alias("pw"))
    top = docs.sparkSession.sparkContext.broadcast(top_tree(nodes.collect()))
    answers = answer(send(blocks, owners, False), state, top, owners)
    scored = score_blocks(blocks, answers, owners, totals["n"] or 0, totals["v"] or 0)
    return scored.withColumn("bits_per_byte", -F.col("score") * (np.log2(10)) / F.col("n_bytes"))
