"""Registered queries of this package and, where SQL can state them, their DuckDB statements."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recurra.llm import bpe, hard_negatives, html_content, merkle, neighbours, order_minhash, packing, pii, quality_model, quality_rules, secrets, sharding, spelling
from recurra.llm.common import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find(table(spark, sf_dir, "documents")))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), changed=31))


ORACLES["op11_hard_negatives"] = """WITH live AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, cast(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM live a JOIN live b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, id, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
negatives AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS place
  FROM positives p JOIN scored n USING (anchor_id) WHERE NOT n.same AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score)
SELECT anchor_id, positive_id, cast(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE place <= 3"""


@query
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
