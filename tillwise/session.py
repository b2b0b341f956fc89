"""Session settings that the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only: they can be set on a session that already runs.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key that holds a large part of a table is split over tasks by the skew join, even
    # when that costs a further exchange for the next operator.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
