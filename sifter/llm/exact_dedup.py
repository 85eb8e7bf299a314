"""Exact dedup: Golomb-coded fingerprint exchange.

1. Every input partition (a *block*) sorts the 64-bit fingerprints of its texts, cuts the list by
   owner (ranges of the fingerprint space) and sends each piece Golomb-coded: about
   log2(range / count) + 1.5 bits a fingerprint in place of 64.
2. An owner decodes the pieces of its range and answers every block with a bitmap: which of its
   fingerprints occur more than once anywhere.
3. Blocks mark their suspects. Only texts of suspects are shuffled, for the byte comparison.

No text moves in 1 and 2; a fingerprint that only one row has never reaches 3.  Copies of one text
are pre-aggregated before the shuffle, so a group holding a third of the rows costs one row a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions

#: Fingerprints an owner decodes at once, about (8 bytes each and a sort).
OWNER_ROWS = 2_000_000


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned 64-bit values as Golomb-coded gaps with a power-of-two parameter
    (Rice code): count, k, first value, the unary quotients' bits, then the k-bit remainders."""
    n = len(values)
    if not n:
        return np.array([0, 0, 0, 0], "<u8").tobytes()
    gaps = np.diff(values)
    mean = float(gaps.mean()) if n > 1 else 1.0
    k = max(0, int(np.floor(np.log2(max(mean * 0.6931, 1.0)))))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1)
    unary = np.zeros(int(ends[-1]) if n > 1 else 0, np.uint8)
    unary[ends - 1] = 1
    unary = np.packbits(unary)
    rest = gaps & np.uint64((1 << k) - 1)
    pieces = []
    for i in range(0, n - 1, 1 << 16):  # whole bytes each, as 65536 * k is a multiple of 8
        bits = np.unpackbits(rest[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        pieces.append(np.packbits(bits[:, 64 - k :]).tobytes())
    head = np.array([n, k, values[0], len(unary)], "<u8").tobytes()
    return head + unary.tobytes() + b"".join(pieces)


def golomb_decode(data: bytes) -> np.ndarray:
    n, k, first, length = (int(x) for x in np.frombuffer(data, "<u8", 4))
    if n < 2:
        return np.array([first] * n, np.uint64)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, length, 32)))[: n - 1]
    gaps = np.diff(ones, prepend=-1).astype(np.uint64) - np.uint64(1)
    gaps <<= np.uint64(k)
    at, body = 32 + length, np.frombuffer(data, np.uint8)
    for i in range(0, n - 1, 1 << 16):
        m = min(1 << 16, n - 1 - i)
        size = (m * k + 7) // 8
        bits = np.zeros((m, 64), np.uint8)
        bits[:, 64 - k :] = np.unpackbits(body[at : at + size])[: m * k].reshape(m, k)
        gaps[i : i + m] += np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
        at += size
    return np.concatenate([np.array([first], np.uint64), np.uint64(first) + np.cumsum(gaps, dtype=np.uint64)])


def owner_of(prints: np.ndarray, owners: int) -> np.ndarray:
    """Range of the fingerprint space, 0 to owners - 1; ascending in the fingerprint."""
    return ((prints >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


def mark_repeated(rows: DataFrame, fp: str = "fp", block: str = "block") -> DataFrame:
    """``rows`` with boolean ``suspect``: another row has the same fingerprint."""
    spark = rows.sparkSession
    owners = max(shuffle_partitions(spark), rows.count() // OWNER_ROWS + 1)

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        prints, counts = np.unique(pdf[fp].to_numpy(np.int64).view(np.uint64), return_counts=True)
        cuts = np.searchsorted(owner_of(prints, owners), np.arange(owners + 1))
        own = [i for i in range(owners) if cuts[i] < cuts[i + 1]]
        return pd.DataFrame(
            {
                "block": pdf[block].iloc[0],
                "owner": np.array(own, np.int64),
                "codes": [golomb_encode(prints[cuts[i] : cuts[i + 1]]) for i in own],
                "again": [np.packbits(counts[cuts[i] : cuts[i + 1]] > 1).tobytes() for i in own],
            }
        )

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [golomb_decode(x) for x in pdf["codes"]]
        prints, counts = np.unique(np.concatenate(lists), return_counts=True)
        shared, out = prints[counts > 1], []
        for own, again in zip(lists, pdf["again"]):
            hit = np.unpackbits(np.frombuffer(again, np.uint8), count=len(own)).astype(bool)
            if len(shared):
                at = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
                hit |= shared[at] == own
            out.append(np.packbits(hit).tobytes())
        return pd.DataFrame({"block": pdf["block"], "owner": pdf["owner"], "bitmap": out})

    def mark(pdf: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        prints, where = np.unique(pdf[fp].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        cuts = np.searchsorted(owner_of(prints, owners), np.arange(owners + 1))
        hit = np.zeros(len(prints), bool)
        for i, bitmap in zip(bitmaps["owner"], bitmaps["bitmap"]):
            size = cuts[i + 1] - cuts[i]
            hit[cuts[i] : cuts[i + 1]] = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=size)
        return pdf.assign(suspect=hit[where])

    sent = rows.select(fp, block).groupBy(block).applyInPandas(send, "block int, owner long, codes binary, again binary")
    bitmaps = sent.groupBy("owner").applyInPandas(answer, "block int, owner long, bitmap binary")
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", suspect boolean"
    return rows.groupBy(block).cogroup(bitmaps.groupBy("block")).applyInPandas(mark, schema)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fingerprint=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are; null counts as empty.  Of equal texts the row with
    the largest doc_id stays; null ids are smallest; of rows that repeat both id and text one
    stays.  An empty table gives an empty result.  Other columns of ``docs`` are ignored.
    ``fingerprint`` maps a text column to a long; equal fingerprints of different texts are told
    apart by their bytes.
    """
    content: Column = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(doc_id).alias("doc_id"), content.alias("text")).withColumn("fp", fingerprint("text"))
    rows = materialise(
        source.select(
            "doc_id",
            "fp",
            F.sha2("text", 256).alias("text_sha256"),
            F.spark_partition_id().alias("block"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "dedup-rows",
    )
    marked = materialise(mark_repeated(rows).drop("block"), "dedup-marked")
    alone = marked.where(~F.col("suspect"))
    suspects = marked.where("suspect").drop("suspect")

    # the byte comparison: different texts under one fingerprint
    prints = suspects.select("fp").distinct()
    texts = source.join(prints, "fp", "left_semi").groupBy("fp", "text").agg(F.lit(1).alias("one"))
    verified = materialise(texts.groupBy("fp").agg(F.count("*").alias("texts")), "dedup-verified")
    mixed = verified.where("texts > 1").select("fp")
    if not mixed.isEmpty():
        # rare: there the SHA-256 of the bytes takes the fingerprint's place
        suspects = suspects.join(mixed.withColumn("mixed", F.lit(True)), "fp", "left").withColumn(
            "part", F.when(F.col("mixed"), F.col("text_sha256"))
        )
    else:
        suspects = suspects.withColumn("part", F.lit(None).cast("string"))
    best = suspects.groupBy("fp", "part").agg(
        F.max(F.struct("doc_id", "rid")).alias("keep"), F.count("*").alias("group_size")
    )
    s, b = suspects.alias("s"), best.alias("b")
    grouped = s.join(b, (F.col("s.fp") == F.col("b.fp")) & F.col("s.part").eqNullSafe(F.col("b.part"))).select(
        F.col("s.doc_id").alias("doc_id"),
        F.col("b.keep.doc_id").alias("keep_id"),
        F.col("b.group_size").alias("group_size"),
        (F.col("s.rid") == F.col("b.keep.rid")).alias("kept"),
        F.col("s.text_sha256").alias("text_sha256"),
    )
    single = alone.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(grouped)
