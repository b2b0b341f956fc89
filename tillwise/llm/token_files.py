"""Token ids of whole documents as files of coded segments, written and read by Spark."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm import rans
from tillwise.llm.common import hide_null, shared_folder, show_null
from tillwise.llm.tokens import END_ID, tokens_of, vocabulary_path

# A segment is closed at the end of the document that reaches this number of ids.
SEGMENT_IDS = 1 << 21

SEGMENT = (
    "part int, segment long, n_ids long, n_blocks int, steps int, table binary, directory binary, "
    "words binary, doc_ids binary, lengths binary"
)
DOCUMENT = "part int, segment long, doc_id long, inside long, n_tokens long, ids_crc32 long"


def _writer(path: str, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tokens, part = tokens_of(path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4")
        ids, lengths, doc_ids, held, number = [], [], [], 0, 0

        def segment() -> pd.DataFrame:
            row = rans.encode(np.concatenate(ids)) | {
                "part": part, "segment": number,
                "doc_ids": zlib.compress(np.array(doc_ids, dtype="<i8").tobytes(), 1),
                "lengths": zlib.compress(np.array(lengths, dtype="<i8").tobytes(), 1),
            }
            return pd.DataFrame([row])[[c.split()[0] for c in SEGMENT.split(", ")]]

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                own = tokens.ids(text if isinstance(text, str) else None)
                ids += [own, end]
                lengths.append(len(own) + 1)
                doc_ids.append(doc_id)
                held += len(own) + 1
                if held >= SEGMENT_IDS:
                    yield segment()
                    ids, lengths, doc_ids, held, number = [], [], [], 0, number + 1
        if ids:
            yield segment()

    return run


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Writes the ids of all texts, in ascending doc_id order, as rows of coded segments.

    The rows are dealt into ranges of doc_id, so that a range is a file, and files and segments are in
    order. A document is never cut between segments. Null texts are empty (they hold only the end
    id); a null doc_id comes first; rows that repeat a doc_id stay next to each other. No
    documents give a folder without segments.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select(hide_null(), "text").repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInPandas(_writer(path or vocabulary_path(), end_id), SEGMENT)
        .write.option("compression", "none").parquet(folder)  # the words are coded already
    )


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            ids = rans.decode(row.n_blocks, row.steps, row.table, row.directory, row.words)
            lengths = np.frombuffer(zlib.decompress(row.lengths), dtype="<i8")
            edges = np.concatenate([[0], np.cumsum(lengths)])
            yield pd.DataFrame({
                "part": row.part, "segment": row.segment,
                "doc_id": np.frombuffer(zlib.decompress(row.doc_ids), dtype="<i8"),
                "inside": edges[:-1], "n_tokens": lengths,
                "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)],
            })


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Decodes the segments: doc_id, start (ids before the document), n_tokens, ids_crc32."""
    files = spark.read.schema(SEGMENT).parquet(folder)
    sizes = files.select("part", "segment", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = (  # one row for each file
        sizes.groupBy("part").agg(F.sum("n_ids").alias("_n"))
        .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_part_start"))
    )
    starts = sizes.join(parts, "part").select(
        "part", "segment",
        (F.col("_part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("_start"),
    )
    return files.mapInPandas(_read, DOCUMENT).join(starts, ["part", "segment"]).select(
        show_null(), (F.col("_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the documents' ids into the shared folder and reads them back."""
    folder = f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, path)
    return read_tokens(docs.sparkSession, folder)
