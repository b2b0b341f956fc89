"""Distinct counts that add up: bitmaps over dense ids, kept by cell and merged instead of counted again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillwise.operators.quality import dense_id


def dense_numbers(df: DataFrame, id: str) -> DataFrame:
    """(id, number): the distinct ids, numbered 1..n in their order. NULL has no number."""
    return dense_id(df.where(F.col(id).isNotNull()).groupBy(id).agg(F.lit(0).alias("_")).select(id), [id], "_number")


def distinct_rollup(fact: DataFrame, dims: Sequence[str], id: str, dense: bool = False) -> DataFrame:
    """(*dims, bucket, bits): which ids each cell has seen, one bit for each.

    Ids are numbered densely first, so that a bitmap of 4 KB holds 32,768 ids whatever their values are; ``dense`` ids are small
    numbers already and go in as they are. Repeated ids of a cell fold before they move. A row takes 4 KB, so cells should be
    coarse enough to hold some hundred ids. Cells that hold only NULL ids have no row.
    """
    dims = list(dims)
    seen = fact.where(F.col(id).isNotNull()).groupBy(*dims, id).agg(F.lit(0).alias("_")).drop("_")
    if dense:
        numbered = seen.withColumn("_number", F.col(id).cast("bigint"))
    else:
        numbered = seen.join(dense_numbers(fact, id), id)
    return numbered.groupBy(*dims, F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits")
    )


def merge_cells(rollup: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The rollup by fewer or coarser dimensions (columns of ``rollup``): bitmaps are merged, no id is seen again."""
    return rollup.groupBy(*dims, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def cell_counts(rollup: DataFrame, dims: Sequence[str], name: str = "ids") -> DataFrame:
    """(*dims, name): distinct ids of each cell; NULL ids don't count."""
    return rollup.groupBy(*dims).agg(F.sum(F.bitmap_count("bits")).alias(name))
