"""A training corpus from ``documents``: five stages, each written and read again.

1. quality rules: rejected documents go;
2. n-gram Jaccard join: one document of each group of near copies stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. PII: personal data is replaced in the text;
5. BPE: what is left as token ids.

Every stage works on all rows that its predecessor kept.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, ngram_join, pii, quality_rules
from strata.llm.common import release, written
from strata.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.reject(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))
                            .otherwise(F.col("n_chars")))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(docs, vocabulary())
    return coded.select("doc_id", F.when(F.col("ids") == "", 0).otherwise(
        F.size(F.split("ids", " "))).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_join", near_copies_stage),
    ("decontaminate", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", tokens_stage),
]

#: Connected components, the latent space, the trees and the merges are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark)
    return docs
