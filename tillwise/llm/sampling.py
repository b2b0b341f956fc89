"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Longer texts are not used for fitting (they are scored like all others).
LONGEST_FIT = 200_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, seed: int) -> DataFrame:
    """doc_id, text, label of at most ``per_class`` documents of each class, in the order of a hash of the id.

    The ids are at most twice ``per_class`` rows, so they are broadcast to the documents; no text is
    shuffled. An id with several labels has the greatest of them.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .withColumn("_order", F.xxhash64(F.lit(seed), "doc_id"))
    )
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy("_order", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.select(F.col("doc_id").alias("_chosen"), "label")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_chosen")).where(
        F.length(F.coalesce("text", F.lit(""))) <= LONGEST_FIT
    ).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")
