"""Customer segments (recency, frequency, monetary) and product value classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions import dollars, ratio, round_half
from tillwise.operators.quantiles import exact_quantiles, quantile_scores, running_share_by_value
from tillwise.operators.shaping import histogram
from tillwise.operators.star import Star, order_revenue
from tillwise.schema import ABC_LABELS

RFM_COLUMNS = ("recency", "frequency", "monetary")


def rfm_base(star: Star) -> DataFrame:
    """Per customer id on revenue orders: last date, orders, spend in cents, days since."""
    per_customer = (
        order_revenue(star, "customer_id", "order_date").where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order_date"), F.count("*").alias("frequency"),
            F.sum("revenue").alias("monetary"),
        )
    )
    return per_customer.withColumn(
        "recency", F.date_diff(F.lit(star.params.as_of), F.col("last_order_date"))
    )


def segment_label(r: Column, f: Column, m: Column) -> Column:
    """First rule that holds, from best to worst."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3) & (m >= 4), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "New Customers")
        .when((r >= 3) & (f >= 3) & (m <= 3), "Potential Loyalists")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r == 1) & (f >= 2), "Lost")
        .when(r + f + m >= 9, "Promising")
        .otherwise("Hibernating")
    )


def scored_customers(star: Star, parity: bool = False) -> DataFrame:
    """Quintile scores and segment per customer, spend in cents.

    A customer without a dated order scores lowest on recency. With ``parity`` a column that
    holds a NULL, or whose quintile edges repeat, scores 3 for everyone.
    """
    scored = quantile_scores(
        rfm_base(star), {"recency": True, "frequency": False, "monetary": False},
        strict=3 if parity else None,
    )
    r, f, m = (F.col(f"{c}_score") for c in RFM_COLUMNS)
    return scored.select(
        "customer_id", "last_order_date", "frequency", "monetary", "recency",
        r.alias("R_score"), f.alias("F_score"), m.alias("M_score"),
        F.concat(*[s.cast("string") for s in (r, f, m)]).alias("RFM_score"),
        segment_label(r, f, m).alias("segment"),
    )


def rfm(star: Star, parity: bool = False) -> DataFrame:
    """The segment table: scores and segment per customer."""
    return scored_customers(star, parity).withColumn("monetary", dollars("monetary"))


def segment_summary(star: Star, parity: bool = False) -> DataFrame:
    """Customers, mean and total spend per segment."""
    return (
        scored_customers(star, parity)
        .groupBy("segment")
        .agg(F.count("*").alias("customers"), F.sum("monetary").alias("spend"))
        .select(
            "segment", "customers",
            ratio(dollars("spend"), "customers", places=2).alias("avg_revenue"),
            dollars("spend").alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "segment")
    )


def rfm_distributions(star: Star, bins: int = 40) -> DataFrame:
    """Histogram of each measure with its median: (metric, bin, lower, upper, n, median).

    The measures are put under each other, so that one pass serves all of them at each step.
    """
    base = rfm_base(star).withColumn("monetary", dollars("monetary"))
    melted = base.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in RFM_COLUMNS
    ])).alias("m")).select("m.metric", "m.v")
    medians = exact_quantiles(melted, "v", [0.5], ["metric"]).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", F.element_at("q", 1))))
    ).scalar()
    return histogram(melted, "v", bins, ["metric"]).withColumn("_medians", medians).select(
        "metric", "bin", round_half("lower", 4).alias("lower"), round_half("upper", 4).alias("upper"),
        "n", round_half(F.col("_medians")[F.col("metric")], 4).alias("median"),
    )


def product_revenue(star: Star) -> DataFrame:
    """All products with their revenue (cents) over every status; unsold ones with 0."""
    sold = star.lines.groupBy("product_id").agg(F.sum("amount").alias("r"))
    return star.costs.join(sold, "product_id", "left").withColumn(
        "revenue", F.coalesce("r", F.lit(0).cast("bigint"))
    ).drop("r")


def cumulative_share(products: DataFrame) -> DataFrame:
    """Distinct revenues with the share of the total made by all products at or above them."""
    return running_share_by_value(products, "revenue").select(
        "revenue", F.col("rows").alias("products"),
        ratio("upto", "total", default=0.0).alias("cumulative_share"),
    )


def abc_classes(products: DataFrame, cuts: tuple[float, ...]) -> DataFrame:
    """``products`` (with ``revenue``) plus ``abc_class`` by cumulative revenue share.

    Only the lowest revenue of each class leaves the cumulation; products are then classed by
    a comparison where they are.
    """
    shares = cumulative_share(products)
    share = F.col("cumulative_share")
    floors = shares.agg(
        F.struct(*[
            F.min(F.when(share <= cut, F.col("revenue"))).alias(f"c{i}")
            for i, cut in enumerate(cuts)
        ])
    ).scalar()
    label = F.when(F.col("revenue") >= F.col("_floors.c0"), ABC_LABELS[0])
    for i, name in list(enumerate(ABC_LABELS[:-1]))[1:]:
        label = label.when(F.col("revenue") >= F.col(f"_floors.c{i}"), name)
    return (
        products.withColumn("_floors", floors)
        .withColumn("abc_class", label.otherwise(ABC_LABELS[-1]))
        .drop("_floors")
    )


def product_abc(star: Star) -> DataFrame:
    return abc_classes(product_revenue(star), star.params.abc_cuts)
