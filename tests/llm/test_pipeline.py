"""The pipeline's stages by themselves, on odd rows and on the small tables."""

import zlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from sifter.llm.toxicity import toxicity

from .test_dedup import plain_components

SF = "/root/testdata/sf0.001"


def test_stages_on_odd_rows(spark, odd, none):
    for name, stage in pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, SF)
            rows = out.collect()
            if name != "packing":
                assert out.columns == docs.columns
            if docs is none:
                assert not rows, name


def test_filters_against_plain_versions(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    left = pipeline.drop_copies(spark, odd, SF).collect()
    assert sorted(r.text or "" for r in left) == sorted({t or "" for _, t in rows})
    left = pipeline.drop_near_copies(spark, odd, SF).collect()
    groups = {(n, c) for _, n, c in plain_components([(k, t) for k, (_, t) in enumerate(rows)])}
    assert len(left) == len({c for _, c in groups})


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = pipeline.run(spark, SF).collect()
    assert pieces and {p.doc_id for p in pieces} <= {r.doc_id for r in docs.collect()}
    used = Counter()
    for p in pieces:
        used[p.sequence_id] += p.length
    assert max(used.values()) <= 4096


def test_toxic_stage_drops_what_the_fitted_operator_rejects(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdict = toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    left = pipeline.drop_toxic(spark, docs, SF)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in verdict if not r.predicted)
    assert 0 < sum(r.predicted for r in verdict) < 0.3 * len(verdict) and len({r.score for r in verdict}) > 20


def test_stages_keep_columns_of_any_name(spark, odd):
    names = ["a.b", "__key", "key", "sha", "__sha", "score", "__score", "n", "kept", "g"]
    docs = odd.select("doc_id", "text", "source", *(F.lit(k).alias(n) for k, n in enumerate(names)))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {tuple(r[3:]) for r in out.collect()} == {tuple(range(len(names)))}, name


def test_toxic_stage_keeps_what_the_operator_accepts(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # no labelled text is at hand: every score is the labels' share, on one side of the threshold or the other
    free = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 4 != 2][:5]
    for toxic, stay in ((1, 200), (2, 0)):
        labels = spark.createDataFrame([(i, int(k < toxic)) for k, i in enumerate(free)], "doc_id long, toxic int")
        labels.write.parquet(f"{tmp_path}/{toxic}/labels.parquet")
        verdict = toxicity(docs, labels).select("doc_id", "score", "predicted").collect()
        left = Counter(r.doc_id for r in pipeline.drop_toxic(spark, docs, f"{tmp_path}/{toxic}").select("doc_id").collect())
        assert {r.score for r in verdict} == {toxic / 5}
        assert left == Counter(r.doc_id for r in verdict if not r.predicted) and sum(left.values()) == stay
