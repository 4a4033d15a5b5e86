"""A corpus pipeline of five stages over ``documents``; the last one packs what is kept.

Every stage works on all rows its predecessor kept. All but the last return the columns of
``documents``:

- language ID: documents for which no language is found go: null, without a letter, or with a code
  far longer than held-out texts of the nearest language need. Without any labelled row nothing is
  learned, and all documents with a letter stay.
- line dedup: repeated lines are cut out of the texts; a document that had lines and loses all
  of them goes. ``n_chars`` follows the text where it is among the columns.
- n-gram Jaccard join: five words, 0.8; one row of each group stays, that with the smallest id (null ids last).
- benchmark decontamination: documents with ten consecutive words of a benchmark item go (or all
  words of a shorter item).
- packing: token sequences of 2048.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import decontaminate, jaccard_join, language_id, line_dedup, packing
from cohortloom.llm.common import cut


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs)
    return language_id.keep_identified(docs, model, most=language_id.limits(docs, model))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs)
    # The operator's two counts come last; the caller may have columns of the same names.
    own = [*docs.columns, "__lines", "__removed"]
    out = out.toDF(*own).filter((F.col("__removed") == 0) | (F.trim(F.regexp_replace("text", r"\s", "")) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("language_id", identify),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_copies),
    ("decontaminate", decontaminated),
    ("packing", pack),
]
#: Learned models and packing are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
