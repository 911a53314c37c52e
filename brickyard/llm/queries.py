"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, imatch, importance, langid, merkle, mixing, packing, template_extract, topk, toxicity, url_tree, warc
from .common import table
from .vertical_join import ngram_jaccard_join


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3)


def op3_template_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_extract.extract(table(spark, sf_dir, "pages"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op5_url_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_tree.judge(table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    return langid.identify(docs, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return records.withColumn("content_length", F.length("block").cast("long")).withColumn("block", F.col("block").cast("string"))


def op8_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), size=2048, end_id=1)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (ngram_jaccard_join(table(spark, sf_dir, "documents"), k=4, percent=85)
            .select("doc_id", "n_shingles", "component_id"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                               order=1, buckets=10_000, percent=10, least_words=20, seed=2024)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_imatch, op2_mixing, op3_template_extract, op4_topk, op5_url_tree, op6_language_id, op7_warc, op8_chat_repair,
    op9_packing, op10_ngram_jaccard, op11_toxicity, op12_importance, op13_merkle)}
