"""The corpus operators bound to the driver tables, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_sql
from .common import read
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .license_scan import scan_licenses
from .lm_scoring import lm_score
from .mixing import entropy_mix
from .packing import pack
from .prefix_trie import prefix_trie
from .quality import classify
from .sharding import balanced_shards
from .structure_repair import structure_repair
from .token_blocks import token_blocks
from .topk import top_k
from .toxicity import toxicity


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2, size=4096)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(read(spark, sf_dir, "documents"))


def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = token_blocks(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return stored.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


OP6_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
         [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


OP7_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def op8_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(read(spark, sf_dir, "documents"))


def op9_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = entropy_mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_token_blocks": op5_token_blocks,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_balanced_sharding": op8_balanced_sharding,
    "op9_entropy_mix": op9_entropy_mix,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_license_scan": op12_license_scan,
    "op13_structure_repair": op13_structure_repair,
}
ORACLE = {
    "op6_exact_top_k": OP6_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op11_prefix_trie": conversation_sql.TRIE,
    "op13_structure_repair": conversation_sql.REPAIR,
}
