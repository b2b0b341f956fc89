"""Foreign-key checks: what is orphaned, and tables split into kept and rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def split_orphans(df: DataFrame, parent: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key exists in the parent, all other rows, NULL keys among them)."""
    keys = parent.select(on)
    return df.join(keys, on, "left_semi"), df.join(keys, on, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """One row: rows whose non-NULL key is missing from the parent.

    Keys are counted before the join, so a heavy key travels as one row.
    """
    keys = child.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n"))
    return keys.join(parent.select(on), on, "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans")
    )


def fk_report(
    checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]
) -> DataFrame:
    """(child, parent, key, orphans) for checks given as (child name, df, parent name, df, key)."""
    rows = [
        orphan_count(child, parent, on).select(
            F.lit(child_name).alias("child"), F.lit(parent_name).alias("parent"),
            F.lit(on).alias("key"), "orphans",
        )
        for child_name, child, parent_name, parent, on in checks
    ]
    return reduce(DataFrame.unionByName, rows)


def screen_rows(
    new: DataFrame, stored: DataFrame, key: str, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """The distinct rows of ``new`` with ``copies`` and the ``verdict`` on appending them to ``stored``.

    ``parents`` gives for each foreign key the table, unique on that column, that must hold its value; NULL refers to nothing. Verdicts, the
    first that holds: ``no key``, ``no parent: <column>``, ``known`` (the very row is stored), ``key taken``
    (another row is stored under the key), ``key repeated`` (an earlier row of the batch has it, by the other columns), ``new``. Equal
    rows fold before anything moves, and only keys of parents are read.
    """
    rest = [c for c in new.columns if c != key]
    rows = new.groupBy(*new.columns).agg(F.count("*").alias("copies")).withColumn("_row", F.struct(*rest))
    held = stored.select(F.col(key), F.struct(*rest).alias("_stored"))
    rows = rows.join(held, key, "left")
    verdict = F.when(F.col(key).isNull(), "no key")
    for column, parent in parents.items():
        known = parent.select(column, F.lit(1).alias(f"_p_{column}"))
        rows = rows.join(known, column, "left")
        verdict = verdict.when(F.col(column).isNotNull() & F.col(f"_p_{column}").isNull(), f"no parent: {column}")
    verdict = (
        verdict.when(F.col("_stored").isNotNull() & F.col("_stored").eqNullSafe(F.col("_row")), "known")
        .when(F.col("_stored").isNotNull(), "key taken").otherwise("new")
    )
    judged = rows.select(*new.columns, "copies", "_row", verdict.alias("verdict"))
    firsts = judged.where("verdict = 'new'").groupBy(F.col(key).alias("_key")).agg(F.min("_row").alias("_first"))
    later = (F.col("verdict") == "new") & ~F.col("_row").eqNullSafe(F.col("_first"))
    return judged.join(firsts, F.col(key) == F.col("_key"), "left").select(
        *new.columns, "copies", F.when(later, "key repeated").otherwise(F.col("verdict")).alias("verdict")
    )
