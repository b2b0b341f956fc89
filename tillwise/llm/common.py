"""Shared by the operators: tables in the shared folder, ids in Python workers, hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of characters other than these six.
SPACES = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application under the folder that all nodes share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets
    a scratch folder of its own. Tables stay until the application's folder is deleted, as lazy
    results read them.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all nodes share")
        named = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids`` (one column), and all rows without a doc_id, which can't be told apart."""
    kept = ids.toDF("_kept_id").unionByName(docs.sparkSession.sql("SELECT CAST(NULL AS BIGINT) AS _kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi")


# pandas has no null in integer columns, so Python workers see this number instead of a null id.
NO_ID = -(1 << 63)


def hide_null(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID)).alias(name)


def show_null(name: str = "doc_id") -> Column:
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)


_HELD: dict[str, object] = {}


def held_by_worker(key: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, once for each Python worker process and key; a worker that turns to another key drops the one before."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold_ascii(text: str | None) -> bytes:
    """UTF-8 bytes of ``text`` with A-Z in lower case; nothing else changes."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def remainder(doc_id: Column, base: int) -> Column:
    """crc32 of the id as text, modulo ``base``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % base
