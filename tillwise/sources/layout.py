"""A stored layout that plans use: orders by month and bucket, lines by bucket, both on ``order_id``."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.operators.star import Star, with_tables

BUCKETS = 16
# A bucket is written by one task and read by one task, so larger tables get more buckets, not larger ones.
BUCKET_ROWS = 2_000_000
MONTH = "order_month"


def shared_folder(spark: SparkSession) -> str:
    """A folder that all nodes share: the one that ``spark.checkpoint.dir`` names; only a local session may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all nodes share")
        named = "file://" + tempfile.mkdtemp(prefix="star-")
    return f"{named.rstrip('/')}/star-{spark.sparkContext.applicationId}"


def bucket_count(star: Star, least: int) -> int:
    """As many buckets as keep each at about ``BUCKET_ROWS`` lines, and orders, but no fewer than ``least``."""
    rows = max(star.lines.count(), star.orders.count())
    return max(least, math.ceil(rows / BUCKET_ROWS))


def _save(df: DataFrame, name: str, folder: str, buckets: int, partition: str | None = None) -> None:
    """Rows go to the task of their bucket first, so that each bucket (of each partition) is one file."""
    key = [F.col("order_id")]
    writer = df.repartition(buckets, *key).write.mode("overwrite").bucketBy(buckets, "order_id").sortBy("order_id")
    if partition:
        writer = writer.partitionBy(partition)
    writer.option("path", f"{folder}/{name}").saveAsTable(name)


def store_star(star: Star, spark: SparkSession, folder: str | None = None, buckets: int = BUCKETS) -> Star:
    """Writes orders and lines as catalog tables and gives the star that reads them.

    Lines and orders have the same buckets on ``order_id``: adding lines up by order and joining them to their orders
    needs no exchange. ``buckets`` is the least number of them: larger tables get more (``bucket_count``).
    Orders also lie in a folder for each month, and date slicers on them (``apply_slice``) name the months too, so
    that other months are not read. Orders without a date are in a month of their own.
    """
    folder = folder or shared_folder(spark)
    buckets = bucket_count(star, buckets)
    name = f"star_{uuid.uuid4().hex}"
    month = F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit("none"))
    _save(star.orders.withColumn(MONTH, month), f"{name}_orders", folder, buckets, MONTH)
    _save(star.lines, f"{name}_lines", folder, buckets)
    return with_tables(star, orders=spark.table(f"{name}_orders"), lines=spark.table(f"{name}_lines"))
