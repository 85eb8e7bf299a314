"""Corpus pipeline: documents through five operators of ``sifter.llm``, each stage's rows written and
read again as the next one's.

Toxic texts go; of equal texts, and of each group of near-duplicates, one document stays; sources
are mixed to their target weights, a document coming as often as the mix takes it; what is left is
packed into sequences. All stages but the last return the columns of ``documents``. Null texts
count as empty in every stage; rows that repeat both id and text count as copies of one text; empty
tables pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm.common import free_name, materialise, quoted, read
from sifter.llm.exact_dedup import exact_dedup
from sifter.llm.jaccard_join import jaccard_components
from sifter.llm.mixing import entropy_mix
from sifter.llm.packing import pack
from sifter.llm.queries import tokenizer_file
from sifter.llm.toxicity import THRESHOLD, learn, score_texts

HELD_OUT = "coalesce(pmod(crc32(cast(doc_id as string)), 4) = 2, false)"


def text_hash() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = learn(docs, read(spark, sf_dir, "labels"), f"NOT {HELD_OUT}")
    score = free_name(docs, "score")
    scored = score_texts(docs, model, docs.columns, out=score)
    return scored.where(quoted(score) < THRESHOLD).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = materialise(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "pipeline-copies")
    sha = free_name(docs, "sha")
    keys = verdict.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone = keys.where(~F.col("kept")).alias("g")
    marked = docs.withColumn(sha, text_hash()).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col(f"d.{sha}") == F.col("g.text_sha256"))
    left = marked.join(gone, same, "left_anti")
    if not keys.where("kept AND n > 1").isEmpty():  # rows that repeat both id and text
        left = left.dropDuplicates(["doc_id", sha])
    return left.drop(sha)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by a hash of id and text, so that one stays where ids are null or repeat;
    of a group it is the one with the smallest hash."""
    name = free_name(docs, "key")
    key = F.xxhash64("doc_id", text_hash())
    found = materialise(jaccard_components(docs.select(key.alias("key"), "text"), doc_id="key"), "pipeline-near")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(name))
    left = docs.withColumn(name, key).join(gone, name, "left_anti")
    if not found.groupBy("doc_id").count().where("count > 1").isEmpty():  # rows that repeat both id and text
        left = left.dropDuplicates([name])
    return left.select(*map(quoted, docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return entropy_mix(docs, whole=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = pack(docs, tokenizer_file("word_bpe_49k.json"), end_id=2, size=4096)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: The stages' models and iterations cannot be said in SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
