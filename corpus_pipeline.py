"""Corpus pipeline over ``documents``: language ID, near-duplicate removal,
mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last keep
the columns of ``documents``.

1. language_id: fits the models on the labelled rows of its own input and
   drops the documents they reject (no letter, or unlike every language);
2. near_duplicates: of each group of documents linked by a Jaccard similarity
   of 0.8 or more on five-word shingles, the one with the least id stays;
3. mixture: each source's rows as often as its target asks (rows repeat);
4. packing: the pieces of every row in sequences of 2048 tokens.

Extra columns of ``documents`` pass through to stage 3. Nulls, empty and
repeated rows: as the operators' docstrings say; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from brickyard.llm import langid, mixing, packing
from brickyard.llm.vertical_join import keep_one
from brickyard.session import checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    return langid.reject(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, k=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_rows(docs, weights=(5, 2, 1), max_epochs=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, size=2048, end_id=1)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("mixture", mixture), ("packing", pack)]

#: Character models and tokenisation can't be written in SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
