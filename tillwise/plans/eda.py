"""The data sets behind the exploratory charts and the summary report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions import dollars, month_start, ratio, round_half, year_month
from tillwise.operators.shaping import box_stats
from tillwise.operators.star import (
    Star, build_fact, order_revenue, revenue_fact, revenue_lines, revenue_orders,
)
from tillwise.operators.windows import rolling_rows, share_of_total, top_n
from tillwise.plans.queries import state_revenue
from tillwise.plans.segments import segment_summary
from tillwise.schema import WEEKDAYS


def master_fact(star: Star) -> DataFrame:
    """Every order line with its order, customer and product attributes."""
    return build_fact(star)


def revenue_rows(star: Star) -> DataFrame:
    """Revenue lines of the master fact with gross profit."""
    return revenue_fact(build_fact(star), star.params.revenue_statuses)


def monthly_orders(star: Star) -> DataFrame:
    return (
        order_revenue(star, "order_date").where("order_date IS NOT NULL")
        .groupBy(month_start("order_date").alias("month"))
        .agg(F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))
    )


def monthly_trend(star: Star) -> DataFrame:
    """Monthly revenue and orders with the mean of the last three rows."""
    mean = ratio(
        dollars(rolling_rows("revenue", 3, "month", F.sum)),
        rolling_rows("revenue", 3, "month", F.count),
        places=2,
    )
    return monthly_orders(star).select(
        year_month("month").alias("order_month"), dollars("revenue").alias("revenue"), "orders",
        mean.alias("revenue_3m_avg"),
    ).orderBy("order_month")


def annual_revenue(star: Star) -> DataFrame:
    """E4."""
    return (
        order_revenue(star, "order_date").where("order_date IS NOT NULL")
        .groupBy(F.year("order_date").alias("order_year"))
        .agg(dollars(F.sum("revenue")).alias("revenue")).orderBy("order_year")
    )


def weekday_orders(star: Star) -> DataFrame:
    """E5: orders by weekday, Monday first; a weekday without orders is NULL."""
    counted = (
        revenue_orders(star, "order_date").where("order_date IS NOT NULL")
        .groupBy(F.weekday("order_date").alias("day")).agg(F.count("*").alias("orders"))
    )
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    spine = counted.sparkSession.range(1).select(F.posexplode(names).alias("day", "order_dow"))
    return spine.join(counted, "day", "left").orderBy("day").select("order_dow", "orders")


def _per_product(star: Star, *order_cols: str) -> DataFrame:
    """Revenue lines added up per product before the product's attributes join."""
    return revenue_lines(star, *order_cols).groupBy("product_id", *order_cols).agg(
        F.sum("amount").alias("revenue"), F.sum("quantity").alias("units"),
        F.sum(F.when(F.col("amount").isNotNull(), F.col("quantity"))).alias("priced_units"),
    )


def _per_category(star: Star) -> DataFrame:
    products = star.costs.select(
        "product_id", "category", F.coalesce("cost", F.lit(0)).alias("cost")
    )
    return (
        _per_product(star).join(products, "product_id").where("category IS NOT NULL")
        .groupBy("category")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum(F.col("revenue") - F.col("priced_units") * F.col("cost")).alias("profit"),
        )
    )


def sum_lattice(star: Star) -> DataFrame:
    """Revenue and profit of revenue orders in all, by category, by channel and by year, from one pass over the lines.

    (grain, category, channel, year, revenue, profit); grain is total, category, channel or year. Lines add up to cells of
    (category, channel, year) first, and only these few are repeated for the grains. Lines of unknown products have no category,
    and no profit.
    """
    products = star.costs.select("product_id", "category", F.coalesce("cost", F.lit(0)).alias("cost"))
    priced = F.when(F.col("amount").isNotNull(), F.col("quantity"))
    cells = (
        star.lines.join(products, "product_id", "left")
        .join(revenue_orders(star, "channel", "order_date"), "order_id")
        .groupBy("category", "channel", F.year("order_date").alias("year"))
        .agg(F.sum("amount").alias("revenue"), F.sum(F.col("amount") - priced * F.col("cost")).alias("profit"))
    )
    grains = cells.groupingSets([["category"], ["channel"], ["year"], []], "category", "channel", "year").agg(
        F.grouping_id().alias("id"), F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
    )
    names = F.create_map(*[F.lit(x) for pair in ((3, "category"), (5, "channel"), (6, "year"), (7, "total")) for x in pair])
    return grains.select(names[F.col("id").cast("int")].alias("grain"), "category", "channel", "year", "revenue", "profit")


def _of(grain: str, value: str, known: str | None = None) -> Column:
    """The value of a lattice row of the grain, whose own column is known."""
    fits = F.col("grain") == grain
    return F.when(fits if known is None else fits & F.col(known).isNotNull(), F.col(value))


def category_margin(star: Star) -> DataFrame:
    """Revenue, profit and margin by category, with the mean of the margins."""
    return _per_category(star).select(
        "category", dollars("revenue").alias("revenue"), dollars("profit").alias("profit"),
        ratio(dollars("profit"), dollars("revenue"), 100.0, 1).alias("margin_pct"),
    ).withColumn(
        "avg_margin_pct", round_half(F.avg("margin_pct").over(Window.partitionBy()), 4)
    ).orderBy("revenue")


def channel_revenue(star: Star) -> DataFrame:
    """Revenue by channel."""
    return (
        order_revenue(star, "channel").where("channel IS NOT NULL").groupBy("channel")
        .agg(dollars(F.sum("revenue")).alias("revenue"))
        .orderBy(F.desc("revenue"), "channel")
    )


def category_share(star: Star) -> DataFrame:
    """Category revenue and its share in percent."""
    return _per_category(star).select(
        "category", dollars("revenue").alias("revenue"),
        round_half(share_of_total("revenue") * 100, 1).alias("share_pct"),
    ).orderBy(F.desc("revenue"), "category")


def top_states(star: Star, n: int = 10) -> DataFrame:
    """States with the most revenue."""
    states = state_revenue(star).select("state", dollars("r").alias("revenue"))
    return top_n(states, n, "revenue", ["state"])


def product_orders_by_category(star: Star) -> DataFrame:
    """(category, orders): orders that hold the category, on revenue lines."""
    return (
        revenue_lines(star, products=star.products.select("product_id", "category"))
        .where("category IS NOT NULL")
        .select("order_id", "category").distinct()
        .groupBy("category").agg(F.count("*").alias("orders"))
    )


def return_rate_by_category(star: Star, fan_out: bool = True) -> DataFrame:
    """Returns against orders by category.

    With ``fan_out`` a return counts once per line of its order that holds the product, as
    the published rates do; the lines are counted per (order, product) and used as a weight.
    """
    returns = star.returns.groupBy("order_id", "product_id").agg(F.count("*").alias("n"))
    if fan_out:
        lines = star.lines.groupBy("order_id", "product_id").agg(
            F.count("*").alias("lines")
        )
        returns = returns.join(lines, ["order_id", "product_id"], "left").withColumn(
            "n", F.col("n") * F.coalesce("lines", F.lit(1))
        )
    by_category = (
        returns.groupBy("product_id").agg(F.sum("n").alias("n"))
        .join(star.products.select("product_id", "category"), "product_id")
        .groupBy("category").agg(F.sum("n").alias("returns"))
    )
    return (
        by_category.join(product_orders_by_category(star), "category")
        .withColumn("return_rate", ratio("returns", "orders", 100.0, 4))
        .orderBy(F.desc("return_rate"), "category")
    )


def return_reasons(star: Star) -> DataFrame:
    """E16."""
    return (
        star.returns.where("reason IS NOT NULL").groupBy("reason")
        .agg(F.count("*").alias("returns")).orderBy(F.desc("returns"), "reason")
    )


def monthly_return_rate(star: Star) -> DataFrame:
    """Returns by the month of their order, against that month's revenue orders."""
    orders = (
        revenue_orders(star, "order_date").where("order_date IS NOT NULL")
        .groupBy(month_start("order_date").alias("m"))
        .agg(F.count("*").alias("orders"))
    )
    per_order = star.returns.groupBy("order_id").agg(F.count("return_id").alias("n"))
    returns = (
        per_order.join(star.orders.select("order_id", "order_date"), "order_id")
        .where("order_date IS NOT NULL")
        .groupBy(month_start("order_date").alias("m")).agg(F.sum("n").alias("returns"))
    )
    return (
        orders.join(returns, "m")
        .select(year_month("m").alias("order_month"), ratio("returns", "orders", 100.0, 4).alias("return_rate"))
        .orderBy("order_month")
    )


def top_products(star: Star, n: int = 20) -> DataFrame:
    """Product names with the most revenue."""
    named = (
        _per_product(star).join(star.products.select("product_id", "product_name"), "product_id")
        .where("product_name IS NOT NULL")
        .groupBy("product_name").agg(dollars(F.sum("revenue")).alias("revenue"))
    )
    return top_n(named, n, "revenue", ["product_name"])


def price_boxes(star: Star) -> DataFrame:
    """List-price box statistics by category, by ascending median."""
    stats = box_stats(
        star.products.where("unit_price IS NOT NULL").select("category", "unit_price"),
        "unit_price", "category",
    )
    numbers = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return stats.select(
        "category", *[round_half(c, 4).alias(c) for c in numbers], "outliers"
    ).orderBy("median", "category")


def _one(df: DataFrame, *cols: str) -> Column:
    """The one row of a frame as a struct, by scalar subquery."""
    return df.select(F.struct(*cols)).scalar()


def headline(star: Star) -> DataFrame:
    """One row of key figures with the strongest category, channel and segment."""
    sums = sum_lattice(star).agg(
        F.max(_of("total", "revenue")).alias("revenue"), F.sum(_of("category", "profit", "category")).alias("profit"),
        F.max_by("category", _of("category", "revenue", "category")).alias("top_category"),
        F.max_by("channel", _of("channel", "revenue", "channel")).alias("top_channel"),
    )
    orders = revenue_orders(star).agg(F.count("*").alias("n"))
    customers = star.customers.agg(F.count_distinct("customer_id").alias("n"))
    returns = star.returns.agg(F.count("*").alias("n"))
    segment = segment_summary(star).agg(
        F.max_by(F.struct("segment", "customers", "total_revenue"), "total_revenue").alias("s")
    )
    return (
        sums.select(
            "*", _one(orders, "n").alias("o"), _one(customers, "n").alias("c"), _one(returns, "n").alias("r"),
            segment.scalar().alias("s"),
        )
        .select(
            dollars("revenue").alias("total_revenue"), dollars("profit").alias("total_profit"),
            ratio(dollars("profit"), dollars("revenue"), 100.0, 4).alias("margin_pct"),
            F.col("o.n").alias("total_orders"), F.col("c.n").alias("total_customers"),
            ratio(dollars("revenue"), "o.n", places=2).alias("avg_order_value"),
            ratio("r.n", "o.n", 100.0, 4).alias("return_rate_pct"),
            "top_category", "top_channel",
            F.col("s.segment").alias("best_segment"),
            F.col("s.customers").alias("best_segment_customers"),
            F.col("s.total_revenue").alias("best_segment_revenue"),
        )
    )


def summary_report(star: Star) -> DataFrame:
    """(section, item, measure, value) of the annual, segment and return tables."""
    def long(df: DataFrame, section: str, item: str, measures: list[str]) -> DataFrame:
        pairs = F.explode(
            F.array(*[
                F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
                for m in measures
            ])
        )
        return df.select(F.col(item).cast("string").alias("item"), pairs.alias("p")).select(
            F.lit(section).alias("section"), "item", "p.measure", "p.value"
        )

    return reduce(DataFrame.unionByName, [
        long(annual_revenue(star), "annual_revenue", "order_year", ["revenue"]),
        long(
            segment_summary(star), "segments", "segment",
            ["customers", "avg_revenue", "total_revenue"],
        ),
        long(return_rate_by_category(star), "return_rates", "category", ["return_rate"]),
    ])
