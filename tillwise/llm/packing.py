"""Packing documents into sequences of bounded length by cutting-stock patterns."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import hide_null, show_null, written
from tillwise.llm.cutting_stock import plan
from tillwise.llm.tokens import END_ID, tokens_of, vocabulary_path

CAPACITY = 4096
UNIT = 16  # lengths are rounded up to this for the patterns, so that there are 256 classes at most

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cutter(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, end = tokens_of(path), np.array([end_id], dtype="<u4")
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.concatenate([tokens.ids(text if isinstance(text, str) else None), end])
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    out.append((doc_id, start, len(piece), zlib.crc32(piece), len(ids)))
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


class _Places:
    """Where the k-th item of a class goes: sequence and slot, from the planned patterns.

    The patterns are laid one after the other; a pattern with a copies of a class, used u times, takes the next a * u items of
    that class. The tables have at most (classes x patterns) rows.
    """

    def __init__(self, classes: np.ndarray, patterns: list[tuple[np.ndarray, int]]):
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        rows: dict[int, list[tuple[int, int, int, int]]] = {int(c): [] for c in classes}
        taken = dict.fromkeys(rows, 0)
        self.sequences = 0
        for pattern, use in patterns:
            slot = 0
            for k in np.flatnonzero(pattern):
                c, copies = int(classes[k]), int(pattern[k])
                rows[c].append((taken[c], copies, self.sequences, slot))
                taken[c] += copies * use
                slot += copies
            self.sequences += use
        for c, found in rows.items():
            self.tables[c] = tuple(np.array(x, dtype=np.int64) for x in zip(*found, strict=True))

    def of(self, c: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, copies, base, slot = self.tables[c]
        at = np.searchsorted(first, rank, side="right") - 1
        inside = rank - first[at]
        return base[at] + inside // copies[at], slot[at] + inside % copies[at]


def _placer(places: _Places, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            sequence, slot = (np.zeros(len(batch), dtype=np.int64) for _ in range(2))
            for c, rows in batch.groupby("_class").indices.items():
                sequence[rows], slot[rows] = places.of(int(c), batch["_rank"].to_numpy()[rows])
            yield batch[columns].assign(sequence_id=sequence, _slot=slot)

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, unit: int = UNIT,
         end_id: int = END_ID) -> DataFrame:
    """Cuts the documents' ids into pieces and gives each piece its place in a sequence.

    A document longer than ``capacity`` gives full pieces, each a sequence of its own, and a rest; a shorter one is
    one rest. The histogram of rests by class (length over ``unit``, rounded up: a few hundred rows) goes to the
    driver, where column generation finds patterns. Rests are ranked within their class and take the places of the
    patterns in this order. Ranks come from about sqrt(n) random buckets in a class of n: a count for each bucket gives its offset, and rows are
    numbered inside buckets, so no class, however common, is numbered in one task.

    Returns one row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null and empty texts are the
    end id alone; a null or repeated doc_id is packed row by row like any other; an empty table gives an empty result.
    sequence_id is unique, not gapless: full pieces come after the patterns' sequences with gaps.
    """
    pieces = written(
        docs.select(hide_null(), "text").mapInPandas(_cutter(path or vocabulary_path(), end_id, capacity), PIECE)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_class", F.when(F.col("length") < capacity, F.ceil(F.col("length") / unit).cast("int")))
    )
    rests = pieces.where("_class IS NOT NULL")
    counts = {r["_class"]: r["n"] for r in rests.groupBy("_class").agg(F.count("*").alias("n")).collect()}
    classes = np.array(sorted(counts), dtype=np.int64)
    demand = np.array([counts[int(c)] for c in classes], dtype=np.int64)
    places = _Places(classes, plan(classes, demand, capacity // unit))

    columns = [c.split()[0] for c in PIECE.split(", ")]
    shown = [show_null(), *columns[1:]]
    full = pieces.where("_class IS NULL").select(
        *shown,
        (F.col("_row") + places.sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    if not counts:
        return full
    buckets = F.create_map(*[x for c, n in counts.items() for x in (F.lit(c), F.lit(int(np.ceil(np.sqrt(n)))))])
    dealt = rests.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.element_at(buckets, F.col("_class"))))
    before = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_class", "_bucket").agg(F.count("*").alias("_n"))
        .select("_class", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_class", "_bucket").orderBy("_row")
    ranked = (
        dealt.withColumn("_at", F.row_number().over(inside) - 1).join(offsets, ["_class", "_bucket"])
        .select(*columns, "_class", (F.col("_before") + F.col("_at")).alias("_rank"))
    )
    placed = ranked.mapInPandas(_placer(places, columns), f"{PIECE}, sequence_id long, _slot long")
    earlier = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        *shown, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")
    ).unionByName(full)
