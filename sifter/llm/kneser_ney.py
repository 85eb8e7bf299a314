"""Interpolated modified Kneser-Ney over byte n-grams of ORDER, with counts that stay in shards.

A *gram* is a byte and the ORDER - 1 before it, one 64-bit number: the nearest byte stands highest, the
byte itself lowest, so in sorted order the grams of a context are neighbours. Documents are gathered
in compressed *blocks* (no shuffle: a block is part of an input partition).

1. Blocks send their distinct grams to shards, dealt by the two bytes before; with counts in the
   documents that are learned from, and once more to ask for them.
2. Shards sum the counts. A gram's shorter forms, down to two bytes of context, lie in the same shard, so
   continuation counts are counted there; Spark sums what all shards share, the numbers of counts 1
   to 4 of each order and the continuation counts of byte pairs (65,536 at most).
3. Shards join what is asked with their counts and answer with probabilities; blocks add up the
   logarithms by document.

Two models are learned alike: ALL of the trusted documents, and REST, those without the ones set
``apart``. The latter are scored by REST too, so there are scores of trusted text that the model has
not seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.session import scratch_path

from . import ctw
from .common import materialise, shuffle_partitions
from .lm_scoring import expand, lookup, pack_keys, sorted_counts, squeeze, unpack_keys

#: Bytes of a gram, and of the context in it. Grams fit 64 bits.
ORDER = 6
DEPTH = ORDER - 1
PAD = b"\n" * DEPTH
#: Bytes of a block, documents of a block, and places worked on at a time.
BLOCK, MOST_DOCS, STEP = 16 << 20, 1 << 20, 1 << 21
MAX_SHARDS = 1024
#: Of the distinct trusted texts one in so many is set apart.
FOLDS = 5
ALL, REST = 0, 1


def modified(n: list[int]) -> list[float]:
    """D1, D2 and D3+ from the numbers of counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = [(k + 1) - (k + 2) * y * n[k + 1] / n[k] if n[k] else y * (k + 1) for k in range(3)]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(out)]


# ---- blocks


def body(text: str | None) -> bytes:
    """Words, single spaces, one end."""
    return b" ".join((text or "").encode("utf-8", "replace").split()) + b"\n"


def make_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``docs``: (doc_id, lang, text) -> blocks (block, doc_id, lang, apart, length, body)."""
    doc_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 20
        names, langs, bodies, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            columns = {
                "block": pa.array([block], pa.int64()),
                "doc_id": pa.array([names], pa.list_(kind)),
                "lang": pa.array([langs], pa.list_(pa.string())),
                # equal texts lie on the same side
                "apart": pa.array([[zlib.crc32(b) % FOLDS == 0 for b in bodies]]),
                "length": pa.array([[len(b) for b in bodies]], pa.list_(pa.int64())),
                "body": pa.array([zstandard.ZstdCompressor(level=3).compress(PAD + PAD[1:].join(bodies))], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        for batch in batches:
            kind = batch.column("doc_id").type
            for name, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                names.append(name)
                langs.append(lang)
                bodies.append(body(text))
                size += len(bodies[-1])
                if size >= block_bytes or len(names) >= MOST_DOCS:
                    yield flush()
                    block, names, langs, bodies, size = block + 1, [], [], [], 0
        if names:
            yield flush()

    schema = f"block long, doc_id array<{doc_type.simpleString()}>, lang array<string>, apart array<boolean>, length array<long>, body binary"
    return docs.mapInArrow(run, schema)


def trusted_bits(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """(block, bits): which of a block's documents have an id in ``known`` (id, distinct); blocks
    without any are missing. Only ids and places are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for places in batch.column("places"):
                mark = np.zeros(MOST_DOCS, bool)
                mark[places.values.to_numpy()] = True
                bits.append(np.packbits(mark[: np.flatnonzero(mark)[-1] + 1]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(bits, pa.binary())], names=["block", "bits"])

    rows = blocks.select("block", F.posexplode("doc_id").alias("place", "id"))
    hits = rows.join(known.hint("merge"), "id", "left_semi")
    return hits.groupBy("block").agg(F.collect_list("place").alias("places")).mapInArrow(run, "block long, bits binary")


class Block:
    """A block read back: the byte stream and of each document its first place, length and class, 0
    (trusted), 1 (trusted, set apart) or 2 (others)."""

    def __init__(self, body: bytes, length: np.ndarray, apart: np.ndarray, bits: bytes | None):
        self.stream = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
        self.length = length
        self.begin = DEPTH + np.cumsum(length + DEPTH - 1) - (length + DEPTH - 1)
        self.trusted = np.zeros(len(length), bool)
        if bits:
            mark = np.unpackbits(np.frombuffer(bits, np.uint8))[: len(length)].astype(bool)
            self.trusted[: len(mark)] = mark
        self.kind = np.where(self.trusted, apart.astype(np.int8), np.int8(2))

    @classmethod
    def of(cls, row) -> Block:
        """From the columns body, length, apart and bits of an Arrow row."""
        length, apart = (row[c].values.to_numpy(zero_copy_only=False) for c in ("length", "apart"))
        return cls(row["body"].as_py(), length, apart, row["bits"].as_py())

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(grams, documents) of all places, in runs."""
        for a in range(DEPTH, len(self.stream), STEP):
            b = min(a + STEP, len(self.stream))
            doc = np.searchsorted(self.begin, np.arange(a, b), side="right") - 1
            keys = self.stream[a:b].astype(np.uint64)
            for k in range(1, ORDER):
                keys |= self.stream[a - k : b - k].astype(np.uint64) << np.uint64(8 * (ORDER - k))
            inside = np.arange(a, b) < self.begin[doc] + self.length[doc]
            yield keys[inside], doc[inside]

    def distinct(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each class its sorted distinct grams and their counts."""
        out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 3
        for keys, doc in self.parts():
            kind = self.kind[doc]
            for c in range(3):
                out[c] = add_up([out[c], sorted_counts(keys[kind == c])])
        return out


def add_up(tables: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    return ctw.merge(*(np.concatenate(x) for x in zip(*tables)))


def shards_of(keys: np.ndarray, shards: int) -> list[np.ndarray]:
    """For each shard the places of its grams, ascending: dealt by the two nearest context bytes."""
    pair = (keys >> np.uint64(8 * (ORDER - 2))) * np.uint64(0x9E3779B97F4A7C15)
    own = ((pair >> np.uint64(32)) & np.uint64(0xFFFFFFFF)) * np.uint64(shards) >> np.uint64(32)
    order = np.argsort(own, kind="stable")
    return np.split(order, np.searchsorted(own[order], np.arange(1, shards)))


def batch_of(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


# ---- the Spark jobs


def send(blocks: DataFrame, shards: int) -> DataFrame:
    """What each block sends to each shard: (shard, model, block, keys, counts), where asked without
    counts."""
    schema = pa.schema([("shard", pa.int64()), ("model", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_struct_array():
                seen = Block.of(row).distinct()
                for model, learn, ask in ((ALL, seen[:2], seen), (REST, seen[:1], seen[1:2])):
                    for tables, counted in ((learn, True), (ask, False)):
                        keys, counts = add_up(tables)
                        rows = [
                            (k, model, row["block"].as_py(), pack_keys(keys[at]), squeeze(counts[at].astype("<i8")) if counted else None)
                            for k, at in enumerate(shards_of(keys, shards))
                            if len(at)
                        ]
                        if rows:
                            yield batch_of(schema, rows)

    return blocks.select("block", "length", "apart", "body", "bits").mapInArrow(run, "shard long, model int, block long, keys binary, counts binary")


def by_depth(keys: np.ndarray, counts: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A shard's grams by bytes of context: counts at DEPTH, below it the numbers of different bytes
    before the gram."""
    out = {DEPTH: (keys, counts)}
    for d in range(DEPTH - 1, 0, -1):
        out[d] = sorted_counts(ctw.shorten(out[d + 1][0], d + 1, d))
    return out


def gather(sent: DataFrame, shards: int) -> DataFrame:
    """Shards' sums: (shard, model, keys, counts), and rows (model, depth, place, n) of what all share:
    at depth 1 the shard's part of a byte pair's continuation count, at others how many counts are ``place``."""
    schema = pa.schema([("shard", pa.int64()), ("model", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("depth", pa.int32()), ("place", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tables = None, []

        def flush() -> pa.RecordBatch:
            keys, counts = add_up(tables)
            shard, model = current
            rows = [(shard, model, pack_keys(keys), squeeze(counts.astype("<i8")), None, None, None)]
            for d, (grams, n) in by_depth(keys, counts).items():
                few = zip(grams.tolist(), n.tolist()) if d == 1 else ((c, int((n == c).sum())) for c in (1, 2, 3, 4))
                rows += [(shard, model, None, None, d, place, m) for place, m in few]
            return batch_of(schema, rows)

        for batch in batches:
            for shard, model, k, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "model", "keys", "counts"))):
                if (shard, model) != current:
                    if current:
                        yield flush()
                    current, tables = (shard, model), []
                tables.append((unpack_keys(k), expand(n, "<i8")))
                if len(tables) >= 16:  # sums replace what they add up
                    tables = [add_up(tables)]
        if current:
            yield flush()

    parts = min(shards, 4 * shuffle_partitions(sent.sparkSession))
    dealt = sent.where("counts IS NOT NULL").repartition(parts, "shard").sortWithinPartitions("shard", "model")
    return dealt.mapInArrow(run, "shard long, model int, keys binary, counts binary, depth int, place long, n long")


def shared(rows: list) -> tuple[np.ndarray, dict[int, list[float]]]:
    """(probability by byte pair, discounts by depth) from the summed rows (depth, place, n)."""
    cut = {}
    for d in range(2, ORDER):
        n = {r["place"]: r["n"] for r in rows if r["depth"] == d}
        cut[d] = modified([n.get(c, 0) for c in (1, 2, 3, 4)])
    pairs = np.zeros((256, 256), np.int64)
    for r in rows:
        if r["depth"] == 1:
            pairs[divmod(r["place"], 256)] = r["n"]
    singles = (pairs > 0).sum(axis=0)

    def smooth(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        d = np.array([0.0, *modified([int((counts == c).sum()) for c in (1, 2, 3, 4)])])[np.minimum(counts, 3)]
        total = counts.sum(axis=-1, keepdims=True)
        own = np.where(total > 0, (counts - d) / np.maximum(total, 1), 0.0)
        back = np.where(total > 0, d.sum(axis=-1, keepdims=True) / np.maximum(total, 1), 1.0)
        return own + back * lower

    one = smooth(singles, np.full(256, 1 / 256))
    return smooth(pairs, one[None, :]).ravel(), cut


class Counts:
    """A shard's counts, ready for questions."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, cut: dict[int, list[float]]):
        self.pairs, self.levels = pairs, []
        for d, (grams, n) in sorted(by_depth(keys, counts).items()):
            if d < 2 or not len(grams):
                continue
            off = np.array([0.0, *cut[d]])[np.minimum(n, 3)]
            context = grams >> np.uint64(8)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            total = np.add.reduceat(n, first)
            own = (n - off) / np.repeat(total, np.diff(np.append(first, len(n))))
            self.levels.append((d, grams, own, context[first], np.add.reduceat(off, first) / total))

    def log2(self, keys: np.ndarray) -> np.ndarray:
        p = self.pairs[ctw.shorten(keys, DEPTH, 1).astype(np.int64)]
        left = np.arange(len(keys))  # whose context is there; a longer one is only if a shorter one is
        for d, grams, own, contexts, back in self.levels:
            short = ctw.shorten(keys[left], DEPTH, d) if d < DEPTH else keys[left]
            at, hit = lookup(contexts, short >> np.uint64(8))
            left, short = left[hit], short[hit]
            p[left] *= back[at[hit]]
            at, hit = lookup(grams, short)
            p[left[hit]] += own[at[hit]]
        return np.log2(p)


def answer(sent: DataFrame, state: DataFrame, models, shards: int) -> DataFrame:
    """(block, model, keys, values): log2 of the probabilities of the grams asked for."""
    schema = pa.schema([("block", pa.int64()), ("model", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        current, counts = None, None
        for batch in batches:
            out = []
            for shard, model, block, k, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "model", "block", "keys", "counts"))):
                if (shard, model) != current:  # its sums come first, if it has any
                    held = (unpack_keys(k), expand(n, "<i8")) if block is None else nothing
                    current, counts = (shard, model), Counts(*held, *models.value[model])
                if block is not None:
                    out.append((block, model, k, squeeze(counts.log2(unpack_keys(k)).astype("<f4"))))
            if out:
                yield batch_of(schema, out)

    sums = state.where("keys IS NOT NULL").select("shard", "model", F.lit(None).cast("long").alias("block"), "keys", "counts")
    parts = min(shards, 4 * shuffle_partitions(sent.sparkSession))
    rows = sums.unionByName(sent.where("counts IS NULL")).repartition(parts, "shard")
    rows = rows.sortWithinPartitions("shard", "model", F.col("block").asc_nulls_first())
    return rows.mapInArrow(run, "block long, model int, keys binary, values binary")


def total_bits(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Per document: doc_id, lang, trusted, n_bytes, perplexity (2 to the mean code length of a byte), and
    ``unseen``, that by REST if it is trusted and set apart, else null."""
    doc_type = blocks.schema["doc_id"].dataType.elementType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        frames = []
        models = right.column("model").to_numpy()
        for row in left.combine_chunks().to_batches()[0].to_struct_array() if left.num_rows else []:
            block = Block.of(row)
            bits = np.zeros((2, len(block.length)))
            for model in (ALL, REST):
                got = right.filter(pa.array(models == model))
                if not got.num_rows:
                    continue
                keys = np.concatenate([unpack_keys(k.as_py()) for k in got.column("keys")])
                values = np.concatenate([expand(v.as_py(), "<f4") for v in got.column("values")])
                order = np.argsort(keys)
                keys, values = keys[order], values[order]
                for k, doc in block.parts():
                    if model == REST:
                        mine = block.kind[doc] == 1
                        k, doc = k[mine], doc[mine]
                    order = np.argsort(k)
                    ordered, found = k[order], np.empty(len(k))
                    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(k) else np.zeros(0, np.int64)
                    each = values[np.searchsorted(keys, ordered[first])]
                    found[order] = np.repeat(each, np.diff(np.append(first, len(k))))
                    bits[model] += np.bincount(doc, weights=found, minlength=len(block.length))
            perplexity = np.exp2(-bits / block.length)
            frames.append(
                pa.table(
                    {
                        "doc_id": row["doc_id"].values,
                        "lang": row["lang"].values,
                        "trusted": block.trusted,
                        "n_bytes": block.length,
                        "perplexity": perplexity[ALL],
                        "unseen": pa.array(perplexity[REST], mask=block.kind != 1),
                    }
                )
            )
        return pa.concat_tables(frames)

    schema = f"doc_id {doc_type}, lang string, trusted boolean, n_bytes long, perplexity double, unseen double"
    columns = blocks.select("block", "doc_id", "lang", "apart", "length", "body", "bits")
    return columns.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def perplexities(docs: DataFrame, known: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, lang, text): doc_id, lang, trusted, n_bytes, perplexity, unseen.

    Trusted are documents whose id is in ``known`` (id, distinct, no nulls); the model is learned from
    all of them. Without any every byte has probability 1/256.
    """
    spark = docs.sparkSession
    # blocks lie in buckets, so that only the answers move when both meet
    table = f"sifter_quality_{uuid4().hex}"
    dealt = make_blocks(docs.select("doc_id", "lang", "text"), block_bytes).write.bucketBy(shuffle_partitions(spark), "block")
    dealt.option("path", scratch_path(spark, "quality-blocks")).saveAsTable(table, format="parquet")
    blocks = spark.table(table)
    # a bit a document, so Spark can send them to the blocks
    bits = materialise(trusted_bits(blocks, known), "quality-trusted")
    marked = blocks.join(bits, "block", "left")
    shards = min(MAX_SHARDS, max(16, blocks.count()))
    sent = materialise(send(marked, shards), "quality-sent")
    state = materialise(gather(sent, shards), "quality-counts")
    # at most 65,536 byte pairs and 24 numbers of counts a model
    rows = state.where("depth IS NOT NULL").groupBy("model", "depth", "place").agg(F.sum("n").alias("n")).collect()
    models = {m: shared([r for r in rows if r["model"] == m]) for m in (ALL, REST)}
    answers = answer(sent, state, spark.sparkContext.broadcast(models), shards)
    scored = materialise(total_bits(marked, answers), "quality-scores")
    spark.sql(f"DROP TABLE {table}")  # the name; the files stay in the scratch folder
    return scored
