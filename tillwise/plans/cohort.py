"""Cohort retention: customers by the month of their first revenue order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.functions import month_index, month_start, ratio, round_half, year_month
from tillwise.operators.star import Star, order_revenue


WORDS = 8  # of 64 months each, from the first order month on


def month_masks(star: Star) -> DataFrame:
    """(customer_id, first, mask): month numbers since the first order month; the mask's bits are the months with a revenue order.

    One aggregation by customer, whose bits combine on the map side. A calendar over WORDS * 64 months fails loudly.
    """
    number = month_index(month_start("order_date"), F.col("_origin"))
    origin = star.orders.agg(month_start(F.min("order_date"))).scalar()
    seen = (
        order_revenue(star, "customer_id", "order_date").where("customer_id IS NOT NULL AND order_date IS NOT NULL")
        .select("customer_id", "order_date", origin.alias("_origin")).select("customer_id", "_origin", number.cast("int").alias("m"))
    )
    too_far = F.raise_error(F.lit(f"the calendar is longer than {WORDS * 64} months")).cast("bigint")
    bit = F.when(F.col("m") < WORDS * 64, F.expr("shiftleft(1L, m % 64)")).otherwise(too_far)
    masks = [F.coalesce(F.bit_or(F.when(F.expr(f"m div 64 = {w}") | (F.col("m") >= WORDS * 64), bit)), F.lit(0).cast("bigint")) for w in range(WORDS)]
    return seen.groupBy("customer_id").agg(
        F.min("m").alias("first"), F.array(*masks).alias("mask"), F.max("_origin").alias("origin")
    )


def _active(i: int) -> str:
    """1 where the bit of month ``first + i`` is set, else 0."""
    return f"coalesce(getbit(get(mask, int((first + {i}) div 64)), int((first + {i}) % 64)), 0)"


def cohort_counts(star: Star, months: int) -> DataFrame:
    """(cohort, `0`, `1`, … ): customers by month of their first revenue order, and how many are active i months later."""
    per_cohort = month_masks(star).groupBy("first", "origin").agg(
        *[F.sum(F.expr(_active(i)).cast("bigint")).alias(str(i)) for i in range(months + 1)]
    )
    return per_cohort.select(
        F.add_months("origin", F.col("first")).alias("cohort"), *[f"`{i}`" for i in range(months + 1)]
    )


def cohort_retention(
    star: Star, months: int | None = None, min_size: int | None = None
) -> DataFrame:
    """Wide matrix: share of each cohort active in month 0..months, in percent to 0.1."""
    months = star.params.cohort_months if months is None else months
    min_size = star.params.cohort_min_size if min_size is None else min_size
    shares = [
        (ratio(F.col(f"`{i}`"), F.col("`0`"), places=3) * 100).alias(str(i)) for i in range(months + 1)
    ]
    return (
        cohort_counts(star, months).where(F.col("`0`") >= min_size)
        .select(year_month("cohort").alias("cohort_month"), *shares).orderBy("cohort_month")
    )


def retention_curve(matrix: DataFrame) -> DataFrame:
    """Mean retention per month index over the cohorts of a matrix."""
    indexes = [c for c in matrix.columns if c != "cohort_month"]
    long = matrix.unpivot(
        ["cohort_month"], [f"`{c}`" for c in indexes], "month_index", "retention"
    )
    return (
        long.groupBy(F.col("month_index").cast("int").alias("month_index"))
        .agg(round_half(F.avg("retention"), 4).alias("avg_retention"))
        .orderBy("month_index")
    )


def retention_excerpt(star: Star, months: int = 6, cohorts: int = 10) -> DataFrame:
    """The first cohorts and months of the matrix, as shown on a page."""
    matrix = cohort_retention(star)
    return matrix.select("cohort_month", *[f"`{i}`" for i in range(months + 1)]).orderBy(
        "cohort_month"
    ).limit(cohorts)
