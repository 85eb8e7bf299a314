"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

``classify`` learns byte n-grams of order 6 (``kneser_ney``): their counts lie in shards, documents'
distinct n-grams join them, and the answers add up to each document's perplexity per byte; a document
stays if that is at most its language's quantile over trusted text that a model has not seen.

``trigram_counts``, ``fit`` and ``perplexities`` are the same model over byte trigrams, whose tables
have a size fixed by construction (2**24, 2**16 and 2**8 entries at most). It sees no word order, and
``classify`` does not use it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.operators.ranks import exact_quantiles

from . import ctw, kneser_ney
from .common import materialise

#: Places counted or scored at a time.
STEP = 1 << 20
#: Share of trusted documents of a language within its threshold, and slack on top of it.
QUANTILE, SLACK = 0.99, 1.05


def stream(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of the texts (words, single spaces, one end) and each text's number of them."""
    bodies = [b" ".join((t or "").encode("utf-8", "replace").split()) + b"\n" for t in texts]
    length = np.array([len(b) for b in bodies], np.int64)
    joined = np.frombuffer(b"\n\n" + b"\n".join(bodies), np.uint8).astype(np.uint32)
    keys = (joined[:-2] << np.uint32(16)) | (joined[1:-1] << np.uint32(8)) | joined[2:]
    # the line break between two texts is a place without meaning
    real = np.ones(len(keys), bool)
    real[np.cumsum(length + 1)[:-1] - 1] = False
    return keys[real], length


def runs(texts: list, characters: int = STEP):
    begin = total = 0
    for k, text in enumerate(texts):
        total += len(text or "") + 1
        if total >= characters:
            yield begin, k + 1
            begin, total = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): of every trigram its count, summed by trigram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in runs(texts):
                own = np.sort(stream(texts[a:b])[0])
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                n = np.diff(np.append(first, len(own)))
                keys, counts = ctw.merge(np.concatenate([keys, own[first]]), np.concatenate([counts, n]))
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], names=["gram", "n"])

    return docs.select(text).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(table: DataFrame) -> list[float]:
    """D1, D2 and D3+ of counts ``n`` from the numbers of counts 1 to 4."""
    row = table.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    return kneser_ney.modified([row[f"n{k}"] or 0 for k in (1, 2, 3, 4)])


def order_table(table: DataFrame, lower: DataFrame | None = None, suffix: int = 0) -> tuple[DataFrame, DataFrame]:
    """One order: ``table`` (gram, n) and the interpolated ``lower`` (gram, p) -> (gram, p) and the
    contexts' weights of the lower order (context, back). The context is all but the last byte;
    ``suffix`` masks a gram's lower-order gram."""
    d = discounts(table)
    cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    rows = table.select("gram", "n", F.shiftright("gram", 8).alias("context"), cut.alias("cut"))
    contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("mass"))
    contexts = contexts.select("context", "total", (F.col("mass") / F.col("total")).alias("back"))
    joined = rows.join(contexts, "context")
    own = (F.col("n") - F.col("cut")) / F.col("total")
    if lower is None:
        probs = joined.select("gram", (own + F.col("back") / 256).alias("p"))
    else:
        below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
        # every suffix of a seen n-gram is seen
        cut_off = joined.withColumn("suffix", F.col("gram").bitwiseAND(suffix))
        probs = cut_off.join(below, "suffix").select("gram", (own + F.col("back") * F.col("q")).alias("p"))
    return probs, contexts.select("context", "back")


def fit(counts: DataFrame) -> Model:
    """The model from the counts of trigrams."""
    three = materialise(counts, "quality-3")
    two = materialise(three.groupBy(F.col("gram").bitwiseAND(0xFFFF).alias("gram")).agg(F.count("*").alias("n")), "quality-2")
    one = materialise(two.groupBy(F.col("gram").bitwiseAND(0xFF).alias("gram")).agg(F.count("*").alias("n")), "quality-1")
    p1, back0 = order_table(one)
    p1 = materialise(p1, "quality-p1")
    p2, back1 = order_table(two, p1, 0xFF)
    p2 = materialise(p2, "quality-p2")
    p3, back2 = order_table(three, p2, 0xFFFF)

    def array(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        pdf = df.toPandas()  # a row a gram or context: at most 2**24
        return pdf.iloc[:, 0].to_numpy(np.int64), pdf.iloc[:, 1].to_numpy(float)

    return Model(*map(array, (back0, p1, back1, p2, back2, p3)))


class Model:
    """The seen n-grams' probabilities and the seen contexts' weights, each as (places, values)."""

    def __init__(self, back0, p1, back1, p2, back2, p3):
        self.parts = back0, p1, back1, p2, back2, p3

    def full(self) -> np.ndarray:
        """log2 probability of each of the 2**24 trigrams' last byte after its first two."""
        back0, p1, back1, p2, back2, p3 = self.parts
        one = np.full(256, (back0[1][0] if len(back0[1]) else 1.0) / 256)
        one[p1[0]] = p1[1]
        weight = np.ones(256)
        weight[back1[0]] = back1[1]
        two = (weight[:, None] * one).ravel()
        two[p2[0]] = p2[1]
        weight = np.ones(1 << 16, np.float32)
        weight[back2[0]] = back2[1]
        three = weight.reshape(256, 256, 1) * two.astype(np.float32).reshape(1, 256, 256)
        three = three.ravel()
        three[p3[0]] = p3[1]
        return np.log2(three, out=three)


def perplexities(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, n_bytes and perplexity (2 to the mean code length of a byte)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**24 n-grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = sent.value.full()
        for batch in batches:
            texts = batch.column(text).to_pylist()
            size, bits = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            for a, b in runs(texts):
                keys, length = stream(texts[a:b])
                cuts = np.cumsum(length) - length
                size[a:b], bits[a:b] = length, np.add.reduceat(logs[keys].astype(np.float64), cuts)
            perplexity = np.exp2(-bits / np.maximum(size, 1))
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(size), pa.array(perplexity)], names=[*keep, "n_bytes", "perplexity"])

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_bytes long, perplexity double"
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_bytes, trusted, perplexity, threshold, keep.

    Trusted are documents with a label row of quality 1; the model is learned from all of them. One in
    FOLDS of their distinct texts is scored by a second model too, learned from the others only: a
    language's threshold is SLACK times the QUANTILE of these perplexities of unseen trusted text;
    languages without them, and null, take that over all languages, or if there are none at all, the
    quantile of the trusted documents' own perplexities. Null texts are empty: one end. Without trusted documents
    all perplexities are 256, there is no threshold, and all stay. Rows that repeat are scored alike; an
    empty table gives no rows.
    """
    # labels may be as many as documents: their joins are by shuffle at any size
    known = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    scored = kneser_ney.perplexities(rows, known)
    unseen = scored.where("unseen IS NOT NULL")
    by_lang = exact_quantiles(unseen.where("lang IS NOT NULL"), "unseen", [QUANTILE], ["lang"]).select("lang", F.col("q").alias("own"))
    by_lang = materialise(by_lang, "quality-thresholds")
    overall = exact_quantiles(unseen, "unseen", [QUANTILE]).first()
    if overall is None or overall["q"] is None:  # no trusted text is set apart
        overall = exact_quantiles(scored.where("trusted"), "perplexity", [QUANTILE]).first()
    fallback = F.lit(overall["q"] if overall else None).cast("double")
    limit = F.coalesce("own", fallback) * SLACK
    return scored.join(by_lang, "lang", "left").select(
        "doc_id", "lang", "n_bytes", "trusted", "perplexity", limit.alias("threshold"),
        F.coalesce(F.col("perplexity") <= limit, F.lit(True)).alias("keep"),
    )
