"""Documents to packed training sequences: language, exact and near copies, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the docs of the
next. All but the last return the columns of ``docs``:

1. language: texts without a language (null, or without a letter) go, nothing else does; a null lang gets the predicted one.
2. exact_dedup: of documents with equal normalised texts, the one with the smallest doc_id stays.
3. near_dedup: one document of each component of near copies stays, the one with the smallest doc_id.
4. mixing: each document comes as often as the mix takes it (not at all, once or twice).
5. packing: one row for each piece of a document, with its place in a sequence.

Rows with null ids, empty texts, repeated rows, extra columns and empty tables go through each stage as its operator
says; a stage that gets no rows returns none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import exact_dedup, langid, minhash, mixing, packing
from tillwise.llm.common import shared_folder
from tillwise.llm.queries import settle


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settle(spark)
    return langid.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settle(spark)
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settle(spark)
    return minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settle(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    settle(spark)
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

# Pieces of a public vocabulary and hash ranks are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
