"""Reading raw files, writing and loading clean tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwise.operators.integrity import screen_rows
from tillwise.schema import CLEAN_SCHEMAS, FOREIGN_KEYS, raw_schema


def read_raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Raw CSV with a header, every column as text: no inference, no second pass."""
    return (
        spark.read.schema(raw_schema(table))
        .option("header", True).option("mode", "PERMISSIVE")
        .csv(f"{folder}/{table}.csv")
    )


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """One directory of part files; never squeezed into a single file."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, mode: str = "overwrite"
) -> None:
    """Catalog table bucketed and sorted by ``key``.

    Writing orders and order_items with the same bucket count on ``order_id`` lets every
    order-grain query join them without an exchange.
    """
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def read_clean(
    spark: SparkSession, path: str, table: str, fmt: str = "parquet"
) -> DataFrame:
    """Clean table with its declared types."""
    reader = spark.read.schema(CLEAN_SCHEMAS[table])
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def load_table(
    spark: SparkSession, path: str, name: str, date_cols: Sequence[str] = (),
    drop_cols: Sequence[str] = (), fmt: str = "parquet",
) -> DataFrame:
    """Drop helper columns, type the dates and register the table for SQL."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path).drop(*drop_cols)
    df = df.withColumns({c: F.to_date(c) for c in date_cols if c in df.columns})
    df.createOrReplaceTempView(name)
    return df


def append_table(
    df: DataFrame, path: str, table: str, fmt: str = "parquet", drop_cols: Sequence[str] = ()
) -> None:
    """Append a clean table's rows, in the declared column order and types, to what is there."""
    kept = df.drop(*drop_cols)
    schema = T.StructType.fromDDL(CLEAN_SCHEMAS[table])
    typed = kept.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in kept.columns])
    write_table(typed, path, fmt, mode="append")


def append_keyed(
    spark: SparkSession, df: DataFrame, path: str, table: str, parents: Mapping[str, str]
) -> DataFrame:
    """Append the rows of ``df`` that keep the table's primary and foreign keys; returns all others but those already stored.

    ``parents`` names the folder of each parent table. The batch is judged once, against what is stored, into a folder next to the
    table (``<path>.staged``, which also holds the rejects with their verdicts); its new rows then go to the table in one job, which Spark
    commits as a whole. After a break at any point the same call can be made again: rows that got in are known
    then. So running it twice changes nothing.
    """
    schema = T.StructType.fromDDL(CLEAN_SCHEMAS[table])
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    keys = {
        column: read_clean(spark, parents[parent], parent).select(column)
        for column, parent in FOREIGN_KEYS[table].items()
    }
    staged = f"{path.rstrip('/')}.staged"
    write_table(screen_rows(typed, stored, schema[0].name, keys), staged)
    judged = spark.read.parquet(staged)
    write_table(judged.where("verdict = 'new'").select(*schema.names), path, mode="append")
    return judged.where("verdict NOT IN ('new', 'known')")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count)."""
    counts = [
        df.agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def export_result(df: DataFrame, path: str) -> None:
    """Write a query result as CSV with a header; errors reach the caller."""
    write_table(df, path, fmt="csv")
