"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import written

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in code point order, null last, repeating
SHARE = 1.5  # of all words
MOST_COPIES = 2.0
SEED = 20_240_117
SIDE = 512  # ranges of the rank value, each cut into as many again


def word_count(text: Column) -> Column:
    """Runs of characters other than the six white ones; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Words to take from each source: source, source_size, target.

    Filling up: a target is the smaller of MOST_COPIES times the source's size and a level times its weight, with one
    level for all at which the targets add up to SHARE of all words. In the order of limit over weight, the
    level that follows if all sources before are at their limit is right at the first
    source which stays under its own. The windows run over one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    listed = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("_w", F.element_at(weights, ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int")))
        .withColumn("_limit", F.col("source_size") * MOST_COPIES)
    )
    every = Window.partitionBy()
    order = Window.orderBy(F.col("_limit") / F.col("_w"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(every) * SHARE - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))
    ) / F.sum("_w").over(later)
    return (
        listed.withColumn("_level", level).withColumn("_at", F.row_number().over(order))
        .withColumn("_open", F.col("_limit") > F.col("_level") * F.col("_w"))
        .withColumn("_first", F.min_by(F.when(F.col("_open"), F.col("_level")), F.when(F.col("_open"), F.col("_at"))).over(every))
        .select(
            "source", "source_size",
            F.when(F.col("_first").isNull(), F.col("_limit"))
            .otherwise(F.least("_limit", F.col("_first") * F.col("_w"))).alias("target"),
        )
    )


def _first_over(rows: DataFrame) -> DataFrame:
    """For each source the first _at whose running sum of sizes, from _start on, is over _rest: _source, _cut, _start.

    The windows run over one row for each _at of a source, SIDE at most.
    """
    up_to = Window.partitionBy("source").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = (
        rows.groupBy("source", "_at").agg(F.sum("size").alias("_sum"), F.first("_rest").alias("_rest"), F.first("_start").alias("_start"))
        .withColumn("_end", F.col("_start") + F.sum("_sum").over(up_to))
    )
    return (
        sums.where(F.col("_end") > F.col("_rest")).groupBy("source")
        .agg(F.min_by(F.struct("_at", (F.col("_end") - F.col("_sum")).alias("start")), "_at").alias("_first"))
        .select(F.col("source").alias("_source"), F.col("_first._at").alias("_cut"), F.col("_first.start").alias("_start"))
    )


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """How many copies of each document the mix takes.

    Each document gets the whole number of copies that its source's ratio (target over size) holds. For the rest, documents of a
    source are ranked by their random odds u / (1 - u) divided by their inclusion odds p / (1 - p), where u is a hash of seed and
    doc_id and p the ratio's fraction, and are taken in this order as long as that brings the words nearer to the target.
    The place of the cut comes from sums over SIDE ranges of the rank value, then over SIDE parts of the range with the cut, so
    that only the documents of one part are ordered; the cut lies where u is near p and the ranges are
    finest. A source with a third of all rows only means bigger sums.

    Returns one row for each row of ``docs``: doc_id, source, size, source_size, target, copies, taken.
    Null texts have no words and are never counted; a null source is a source of its own, the last one; equal rank values go by
    doc_id (null last); a repeated doc_id gets the same u in each row; an empty table gives an empty result.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return _decided(written(sized), [], seed).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def _decided(sized: DataFrame, key: list[str], seed: int) -> DataFrame:
    """The decisions of ``mix`` for written rows with their sizes; ``key`` are columns that tell rows with equal ids apart."""
    goals = targets(sized).select(F.col("source").alias("_source"), "source_size", "target")
    u = (F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id"), F.lit(-1))).bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)
    p = F.col("_fraction")
    ranked = (
        sized.join(goals, sized["source"].eqNullSafe(goals["_source"])).drop("_source")
        .withColumn("_ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("_whole", F.floor("_ratio"))
        .withColumn("_fraction", F.col("_ratio") - F.col("_whole"))
        .withColumn("_rest", F.col("_fraction") * F.col("source_size"))
        .withColumn("_u", u)
        .withColumn("_rank", F.when(p > 0, (F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p))))
        .withColumn("_bucket", F.floor(F.col("_rank") / (1 + F.col("_rank")) * SIDE * SIDE))
    )
    counted = ranked.where("_bucket IS NOT NULL AND size > 0")
    side = F.floor(F.col("_bucket") / SIDE)
    coarse = _first_over(counted.withColumn("_at", side).withColumn("_start", F.lit(0).cast("long")))
    inside = counted.withColumn("_at", side).join(
        coarse, counted["source"].eqNullSafe(coarse["_source"]) & (F.col("_at") == F.col("_cut"))
    ).select("source", "size", "_rest", "_start", F.col("_bucket").alias("_at"))
    cuts = _first_over(inside)
    placed = ranked.join(cuts, ranked["source"].eqNullSafe(cuts["_source"]), "left").drop("_source")
    at_cut = (F.col("_bucket") == F.col("_cut")) & (F.col("size") > 0)
    before = (
        Window.partitionBy("source").orderBy("_rank", F.col("doc_id").asc_nulls_last(), *key)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    total = F.col("_start") + F.coalesce(F.sum("size").over(before), F.lit(0))
    edge = placed.where(at_cut).withColumn(
        "_extra", (2 * total + F.col("size") <= 2 * F.col("_rest")).cast("long")
    )
    clear = placed.where(~F.coalesce(at_cut, F.lit(False))).withColumn(
        "_extra", (F.col("_bucket").isNotNull() & (F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut")))).cast("long")
    )
    copies = F.col("_whole") + F.col("_extra")
    return clear.unionByName(edge).select(
        *key, "doc_id", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken, all columns as they were.

    Rows are written with a key of their own, so that copies go to the row they were decided for, also where ids are null or repeated.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()))
    sized = written(rows.select("_row", "doc_id", "source", word_count(F.col("text")).alias("size")))
    copies = _decided(sized, ["_row"], seed).where("copies > 0").select("_row", F.col("copies").alias("_copies"))
    joined = rows.join(copies, "_row")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        *[rows[c] for c in docs.columns]
    )
