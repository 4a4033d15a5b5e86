"""The stages, each on what its predecessor kept."""

import random

import corpus_pipeline
from fixtures import odd_rows, table
from pyspark.sql import functions as F

from cohortloom.llm.common import cut


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, ids = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, sf), name)
        assert docs.columns == columns
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids is None or now <= ids
        ids = now
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()} == ids


def test_odd_rows_pass_every_stage(spark):
    for rows in (odd_rows(), []):
        docs = table(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = cut(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.count() == 0 if not rows else docs.count() > 10


def test_language_stage_rejects_by_the_model(spark):
    sf, rnd = "/root/testdata/sf0.01", random.Random(4)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    noise = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(3000))
    other = " ".join("".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(9)) for _ in range(90))
    odd = spark.createDataFrame([(-1, noise, "en"), (-2, other, None), (-3, "...", "en"), (-4, "Xylo ok", None)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, docs.union(odd), sf).select("doc_id").collect()}
    clean = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not kept & {-1, -2, -3} and -4 in kept and len(clean - kept) <= len(clean) // 100
    unlabelled = docs.union(odd).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify(spark, unlabelled, sf).count() == len(clean) + 3
