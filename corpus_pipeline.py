"""Corpus pipeline: quality rules, quality classifier, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage before it
kept. All but the last return the columns of ``documents`` as they came in; the last
returns the pieces of the packed sequences.

In every stage null texts are empty, null and repeated ids are kept as rows of their own,
whole texts of any length are read, other columns pass through under whatever names, and an
empty table gives an empty result. Texts with too few words, the empty ones among
them, do not pass the quality rules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recurra.llm import order_minhash, packing, quality_model, quality_rules, secrets
from recurra.llm.common import ship_package, stored

TOKENIZER = "word_bpe_49k.json"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality_rules.keep_good(docs, labels(spark, sf_dir))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score at or above the threshold."""
    ship_package(spark)
    params = quality_model.Params()
    model = quality_model.train(docs, labels(spark, sf_dir), params)
    scored = quality_model.score(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text"), model, params)
    return scored.where(F.col("quality_score") >= params.threshold).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship_package(spark)
    return order_minhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secret values replaced by a mark."""
    ship_package(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and place."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("packing", pack)]
#: the stages are no SQL; they are tested against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
