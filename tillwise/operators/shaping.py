"""Pivots, histograms and box-plot statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.operators.quantiles import exact_quantiles


def pivot_values(
    df: DataFrame, rows: Sequence[str], col: str, values: Sequence, agg: Column,
    fill: float | int | None = 0,
) -> DataFrame:
    """Wide form with the columns given up front, so no extra job looks for them."""
    wide = df.groupBy(*rows).pivot(col, list(values)).agg(agg)
    return wide if fill is None else wide.fillna(fill, [str(v) for v in values])


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between min and max, the last one closed: (*by, bin, lower, upper, n).

    Bins without a row are listed with n = 0; equal min and max spread half a unit each way. The
    edges of all groups (few: metrics, categories) reach the rows as one map.
    """
    by = list(by)
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    values = df.select(group.alias("g"), F.col(col).cast("double").alias("v")).where("v IS NOT NULL")
    flat = F.col("lo") == F.col("hi")
    edges = values.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).select(
        "g", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    limits = edges.agg(
        F.map_from_entries(F.collect_list(F.struct("g", F.struct("lo", "hi"))))
    ).scalar()
    width = F.col("e.hi") - F.col("e.lo")
    counted = (
        values.withColumn("_limits", limits).withColumn("e", F.col("_limits")[F.col("g")])
        .select("g", F.least(
            F.floor((F.col("v") - F.col("e.lo")) / width * bins), F.lit(bins - 1)
        ).cast("int").alias("bin"))
        .groupBy("g", "bin").agg(F.count("*").alias("n"))
    )
    step = (F.col("hi") - F.col("lo")) / bins
    spine = edges.select(
        "g", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return spine.join(counted, ["g", "bin"], "left").select(
        *[F.col(f"g.{c}").alias(c) for c in by], "bin",
        (F.col("lo") + F.col("bin") * step).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, value: str, by: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and outlier count per group."""
    quartiles = exact_quantiles(df, value, (0.25, 0.5, 0.75), [by]).select(
        by,
        F.element_at("q", 1).alias("q1"),
        F.element_at("q", 2).alias("median"),
        F.element_at("q", 3).alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * k
    fences = quartiles.agg(F.map_from_entries(F.collect_list(F.struct(
        F.struct(by).alias("g"),
        F.struct("q1", "median", "q3", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper")),
    )))).scalar()
    v = F.col(value).cast("double")
    inside = v.between(F.col("f.lower"), F.col("f.upper"))
    return (
        df.withColumn("_fences", fences).withColumn("f", F.col("_fences")[F.struct(by)])
        .where(F.col(by).isNotNull() & F.col("f").isNotNull())
        .groupBy(by, "f.q1", "f.median", "f.q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.count(F.when(~inside, F.lit(1))).alias("outliers"),
        )
    )
