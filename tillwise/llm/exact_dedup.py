"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import SPACES, rows_of, written

PREFIX_CHARS = 256
# The keys that still have company after the prefix stage, as a bitmap of hashed keys in maps of 4 KB, SLOTS slots for each key
# and at most MOST_MAPS maps (16 MB), as they are broadcast. A wrong hit only costs a hash that was not needed.
MAP_BITS = 4096 * 8
SLOTS = 16
MOST_MAPS = 4096
HOT_PARTS = 1024  # a group with over one part in HOT_PARTS of the rows with company is hot: there are fewer than HOT_PARTS


def normalised(text: Column) -> Column:
    """Runs of white space as one space each; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _slot(maps: int, *key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(maps * MAP_BITS))


def exact_groups(docs: DataFrame, digests: bool = False) -> DataFrame:
    """Finds documents whose normalised texts are equal.

    Three stages, each only for what the one before left in company: the length in bytes, the hash
    of the first 256 characters, and SHA-256 of the whole text. The first two come from one
    scan; the last reads the texts again and hashes only documents whose (length, prefix) key is set in a
    bitmap sized by the keys that are left (``digests`` asks for the hash of every text, from the same scan). Groups are
    minima and counts, combined before any shuffle, so that a group with a third of all rows costs one row for each task. On the way
    back to the rows, the few hot groups are broadcast, and no key of the join is hot.

    Returns one row for each row of ``docs``: doc_id, keep_id, group_size, kept, and text_sha256 with ``digests``. A null text
    counts as empty; a text of white space only is one space, and so is not empty. A null doc_id
    is greater than all others. Rows that repeat a doc_id count one by one and get the same answer;
    a group with no other id has keep_id null. An empty table gives an empty result.
    """
    text = normalised(F.col("text"))
    keys = written(
        docs.select("doc_id", text.alias("_t")).select(
            "doc_id", F.octet_length("_t").cast("long").alias("_len"),
            F.xxhash64(F.substring("_t", 1, PREFIX_CHARS)).alias("_prefix"),
        )
    )
    counted = keys.groupBy("_len", "_prefix").agg(F.count("*").alias("_n"))
    lengths = counted.groupBy("_len").agg(F.sum("_n").alias("_same")).where("_same > 1").select("_len")
    prefixes = written(counted.join(lengths, "_len").where("_n > 1").select("_len", "_prefix"))
    maps = max(1, min(MOST_MAPS, -(-prefixes.count() * SLOTS // MAP_BITS)))
    bitmap = (
        prefixes.select(_slot(maps, F.col("_len"), F.col("_prefix")).alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_map"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    )
    slot = _slot(maps, F.octet_length("_t").cast("long"), F.xxhash64(F.substring("_t", 1, PREFIX_CHARS)))
    place = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    full = F.sha2(F.col("_t").cast("binary"), 256)
    hashed = written(
        docs.select("doc_id", text.alias("_t")).withColumn("_slot", slot)
        .withColumn("_map", F.bitmap_bucket_number("_slot"))
        .join(F.broadcast(bitmap), "_map", "left")  # MOST_MAPS rows of 4 KB at most
        .select(
            "doc_id", F.octet_length("_t").cast("long").alias("_len"), hit.alias("_hit"), (full if digests else F.when(hit, full)).alias("_full"),
        )
    )
    company = hashed.where("_hit")
    groups = company.groupBy("_len", "_full").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    bar = company.agg(F.count("*") / HOT_PARTS).scalar()
    hot = F.broadcast(groups.where(F.col("group_size") > bar))
    shown = ["doc_id", "keep_id", "group_size", *(["_full"] if digests else [])]
    alone = hashed.where("NOT _hit").withColumn("keep_id", F.col("doc_id")).withColumn("group_size", F.lit(1).cast("long"))
    together = company.join(hot, ["_len", "_full"])
    rest = company.join(hot, ["_len", "_full"], "left_anti").join(groups, ["_len", "_full"])
    every = alone.select(*shown).unionByName(together.select(*shown)).unionByName(rest.select(*shown))
    return every.withColumnRenamed("_full", "text_sha256").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text an earlier id has; all columns as they were. Rows without an id stay."""
    return rows_of(docs, exact_groups(docs.select("doc_id", "text")).where("kept").select("doc_id"))
