"""Token ids on disk: patched frame-of-reference blocks.

The ids of a run of documents make a *segment*, a self-contained byte string. Its ids are cut into
blocks of 256; a block stores its minimum, the differences in as many bits as a percentile of them
needs, and the high bits of the others as a list of exceptions. The percentile is the block's own:
the one that makes it smallest. An index holds the start of every block,
so any id is read by decoding one block. All numbers are little-endian:

    u64 magic, documents D, ids N, blocks B
    i64 doc_id[D]; u8 id_is_null[D]; u64 ids_before[D]  (in the segment)
    u64 start[B]  (bytes into the payload); u32 minimum[B]; u8 width[B]; u16 exceptions[B]
    payload: per block 4 * width u64 words, then its exceptions: u8 place[], u32 high_bits[]

In the words of a block value i lies in lane i % 4 at bit (i // 4) * width. Segments are rows of
Parquet files: Spark's committer then makes every write atomic, on any store and when executors
are lost; the segment bytes are stored as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.session import scratch_path

from .common import shuffle_partitions
from .tokens import encoder, slices

MAGIC = 0x31524F465054_4B53
BLOCK = 256
#: Bits of an exception: its place and its high bits.
EXCEPTION = 40
#: Ids of a segment, about.
SEGMENT = 1 << 20


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(m, 256) values below 2**width -> (m, 4 * width) words."""
    out = np.zeros((len(values), max(width, 1), 4), np.uint64)
    lanes = values.reshape(-1, 64, 4)
    for i in range(64 if width else 0):
        word, shift = divmod(i * width, 64)
        out[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return out[:, :width].reshape(len(values), 4 * width)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """(m, 4 * width) words -> (m, 256) values."""
    out = np.zeros((len(words), 64, 4), np.uint64)
    lanes = words.reshape(-1, width, 4) if width else words
    mask = np.uint64((1 << width) - 1)
    for i in range(64 if width else 0):
        word, shift = divmod(i * width, 64)
        value = lanes[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (lanes[:, word + 1] << np.uint64(64 - shift))
        out[:, i] = value & mask
    return out.reshape(len(words), BLOCK)


def write_segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """The segment of these documents, whose ids are unsigned 32-bit numbers."""
    flat = np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.uint64)
    before = np.cumsum([0, *map(len, ids)])[:-1]
    blocks = -(-len(flat) // BLOCK)
    grid = np.concatenate([flat, np.repeat(flat[-1:], blocks * BLOCK - len(flat))]).reshape(blocks, BLOCK)
    low = grid.min(axis=1, initial=2**32 - 1)
    grid = grid - low[:, None]
    # bit lengths: the exponents of doubles, which hold these numbers exactly
    bits = np.maximum((grid.astype(np.float64).view(np.int64) >> 52) - 1022, 0)
    fits = np.bincount((bits + 33 * np.arange(blocks)[:, None]).ravel(), minlength=33 * blocks).reshape(blocks, 33)
    width = np.argmin(BLOCK * np.arange(33) + EXCEPTION * (BLOCK - np.cumsum(fits, axis=1)), axis=1)
    over = bits > width[:, None]
    count = over.sum(axis=1)
    size = 32 * width + 5 * count
    start = np.concatenate([[0], np.cumsum(size)])
    payload = np.zeros(start[-1], np.uint8)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        if w:
            words = pack(grid[at] & np.uint64((1 << int(w)) - 1), int(w)).astype("<u8").view(np.uint8)
            payload[start[at][:, None] + np.arange(32 * w)] = words.reshape(len(at), 32 * w)
    block, place = np.nonzero(over)
    turn = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    lists = start[block] + 32 * width[block]
    payload[lists + turn] = place
    high = (grid[block, place] >> width[block].astype(np.uint64)).astype("<u4").view(np.uint8).reshape(-1, 4)
    payload[(lists + count[block] + 4 * turn)[:, None] + np.arange(4)] = high
    head = [
        np.array([MAGIC, len(ids), len(flat), blocks], "<u8"),
        np.array([d or 0 for d in doc_ids], "<i8"),
        np.array([d is None for d in doc_ids], "u1"),
        before.astype("<u8"),
        start[:-1].astype("<u8"),
        low.astype("<u4"),
        width.astype("u1"),
        count.astype("<u2"),
    ]
    return b"".join(x.tobytes() for x in head) + payload.tobytes()


class Segment:
    """A segment read back; ``ids(a, b)`` decodes only the blocks that hold ids a to b - 1."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        magic, docs, self.size, blocks = (int(x) for x in self.data[:32].view("<u8"))
        if magic != MAGIC:
            raise ValueError("not a segment")
        at = 32

        def field(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, n, at)
            at += got.nbytes
            return got

        doc_ids, missing = field("<i8", docs), field("u1", docs)
        self.doc_ids = [None if m else int(d) for d, m in zip(doc_ids, missing)]
        self.before = field("<u8", docs).astype(np.int64)
        self.start = field("<u8", blocks).astype(np.int64)
        self.low, self.width = field("<u4", blocks).astype(np.uint64), field("u1", blocks).astype(np.int64)
        self.count = field("<u2", blocks).astype(np.int64)
        self.payload = self.data[at:]

    def ids(self, begin: int, end: int) -> np.ndarray:
        first, last = begin // BLOCK, -(-end // BLOCK)
        out = np.zeros((last - first, BLOCK), np.uint64)
        start, width, count = self.start[first:last], self.width[first:last], self.count[first:last]
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            words = self.payload[start[at][:, None] + np.arange(32 * w)].view("<u8").reshape(len(at), 4 * w)
            out[at] = unpack(words, int(w))
        block = np.repeat(np.arange(last - first), count)
        turn = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        lists = start[block] + 32 * width[block]
        place = self.payload[lists + turn]
        high = self.payload[(lists + count[block] + 4 * turn)[:, None] + np.arange(4)].view("<u4").ravel()
        out[block, place] |= high.astype(np.uint64) << width[block].astype(np.uint64)
        out += self.low[first:last, None]
        return out.ravel()[begin - first * BLOCK : end - first * BLOCK].astype(np.uint32)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text (null: empty), append ``end_id`` and write the segments to ``path``.

    Documents go in ascending order of id (null ids first; rows that repeat an id in no fixed
    order): ranges of ids make the partitions, each written in order. ``tokenizer`` must be
    readable at that path on every executor. Other columns are ignored; an empty table writes
    no segment.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        names, ids, held, before = [], [], 0, 0
        end = np.array([end_id], np.uint32)

        def segment() -> pa.RecordBatch:
            row = [part, before, held, len(ids), write_segment(names, ids)]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row[:-1]] + [pa.array(row[-1:], pa.binary())], names=["part", "first", "ids", "docs", "segment"])

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for a, b, texts in slices(batch.column("text")):
                for name, x in zip(doc_ids[a:b], enc.encode(texts)):
                    names.append(name)
                    ids.append(np.concatenate([x, end]))
                    held += len(x) + 1
                if held >= SEGMENT:
                    yield segment()
                    before += held
                    names, ids, held = [], [], 0
        if ids:
            yield segment()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    segments = ranged.mapInArrow(encode, "part long, first long, ids long, docs long, segment binary")
    segments.write.option("compression", "none").parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian unsigned 32-bit)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, data in zip(*(batch.column(c) for c in ("part", "first", "segment"))):
                seg = Segment(data.as_py())
                flat = seg.ids(0, seg.size).astype("<u4").tobytes()
                cuts = [*(4 * seg.before).tolist(), len(flat)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * len(seg.doc_ids), pa.int64()),
                        pa.array(seg.doc_ids, pa.int64()),
                        pa.array(first.as_py() + seg.before, pa.int64()),
                        pa.array([flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    ],
                    names=["part", "doc_id", "at", "ids"],
                )

    stored = spark.read.schema("part long, first long, ids long, docs long, segment binary").parquet(path)
    # one row a written partition
    sizes = sorted((r["part"], r["n"]) for r in stored.groupBy("part").agg(F.sum("ids").alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    parts = spark.createDataFrame(offsets, "part long, offset long")
    rows = stored.select("part", "first", "segment").mapInArrow(decode, "part long, doc_id long, at long, ids binary")
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("at") + F.col("offset")).alias("start"), "ids")


def token_blocks(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write ``docs`` as token blocks (by default under the shared scratch folder) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(spark, path)
