"""The data sets that only the dashboard pages use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions import dollars, month_start, ratio, round_half, year_month
from tillwise.operators.shaping import pivot_values
from tillwise.operators.star import Star, order_revenue, revenue_fact, revenue_orders
from tillwise.operators.windows import rank_by, rolling_rows, top_n
from tillwise.plans.eda import _of, _per_category, _per_product, monthly_orders, return_rate_by_category, sum_lattice
from tillwise.plans.queries import category_metrics, daily_revenue, q11
from tillwise.plans.segments import rfm_base, rfm_distributions, segment_summary


def dashboard_fact(star: Star) -> DataFrame:
    """Lines of revenue orders with product cost and gross profit."""
    orders = revenue_orders(
        star, "order_date", month_start("order_date").alias("order_month"), "channel", "status",
        "state", "customer_id", geo=True,
    )
    products = star.products.select("product_id", "category", "unit_cost", "brand")
    lines = star.order_items.join(orders, "order_id").join(products, "product_id", "left")
    return revenue_fact(lines, star.params.revenue_statuses)


def monthly_change(star: Star) -> DataFrame:
    """Monthly revenue, orders, three-row mean and change in percent."""
    before = F.lag("revenue").over(Window.orderBy("month"))
    mean = ratio(
        dollars(rolling_rows("revenue", 3, "month", F.sum)),
        rolling_rows("revenue", 3, "month", F.count),
        places=2,
    )
    return monthly_orders(star).select(
        year_month("month").alias("order_month"), dollars("revenue").alias("revenue"), "orders",
        mean.alias("rev_3m"),
        ratio(dollars(F.col("revenue") - before), dollars(before), 100.0, 4).alias("mom_pct"),
    ).orderBy("order_month")


def page_kpis(star: Star) -> DataFrame:
    """Key figures with the growth between the two given years."""
    first, second = star.params.growth_years
    # Undated lines count in the totals but in no year.
    totals = sum_lattice(star).agg(
        F.max(_of("total", "revenue")).alias("revenue"), F.sum(_of("category", "profit", "category")).alias("p"),
        F.max(F.when(F.col("year") == first, _of("year", "revenue"))).alias("y1"),
        F.max(F.when(F.col("year") == second, _of("year", "revenue"))).alias("y2"),
    )
    orders = revenue_orders(star).agg(F.count("*")).scalar()
    customers = star.customers.agg(F.count_distinct("customer_id")).scalar()
    returns = star.returns.agg(F.count("*")).scalar()
    return totals.withColumns({"o": orders, "c": customers, "rt": returns}).select(
        dollars("revenue").alias("total_revenue"), dollars("p").alias("total_profit"),
        ratio(dollars("p"), dollars("revenue"), places=6).alias("margin"), F.col("o").alias("total_orders"),
        F.col("c").alias("total_customers"),
        ratio(dollars("revenue"), "o", places=2).alias("avg_order_value"),
        ratio("rt", "o", places=6).alias("return_rate"),
        ratio(dollars(F.col("y2") - F.col("y1")), dollars("y1"), places=6).alias("yoy_growth"),
    )


def trailing_revenue(star: Star) -> DataFrame:
    """Revenue of the last 3 and 12 months with sales, and of the latest year."""
    latest = F.row_number().over(Window.orderBy(F.desc("month")))
    return (
        monthly_orders(star).withColumn("age", latest)
        .agg(
            dollars(F.sum(F.when(F.col("age") <= 3, F.col("revenue")))).alias("rolling_3m"),
            dollars(F.sum(F.when(F.col("age") <= 12, F.col("revenue")))).alias("rolling_12m"),
            dollars(
                F.sum(F.when(F.year("month") == star.params.latest_year, F.col("revenue")))
            ).alias("ytd"),
        )
    )


def daily_trend(star: Star, rows: int = 30) -> DataFrame:
    """P5: daily revenue with the mean of the last 30 days that had revenue."""
    mean = ratio(
        dollars(rolling_rows("daily_revenue", rows, "order_date", F.sum)),
        rolling_rows("daily_revenue", rows, "order_date", F.count), places=2,
    )
    return daily_revenue(star).select(
        "order_date", dollars("daily_revenue").alias("revenue"), mean.alias("rolling_mean")
    ).orderBy("order_date")


def aov_by_channel(star: Star) -> DataFrame:
    """Order value by channel and year, 0 where a channel sold nothing in a year of the data."""
    per_year = (
        order_revenue(star, "channel", "order_date").where("order_date IS NOT NULL")
        .groupBy("channel", F.year("order_date").alias("year"))
        .agg(ratio(dollars(F.sum("revenue")), F.count("*"), places=2).alias("aov"))
    )
    # A few dozen years at most, so they travel as one array.
    years = per_year.agg(F.sort_array(F.collect_set("year"))).scalar()
    own = F.map_from_entries(F.collect_list(F.struct("year", "aov")))
    return (
        per_year.groupBy("channel").agg(own.alias("own"))
        .withColumn("years", years).select("channel", "own", F.explode("years").alias("year"))
        .select("channel", "year", F.coalesce(F.col("own")[F.col("year")], F.lit(0.0)).alias("aov"))
        .orderBy("channel", "year")
    )


def customer_kpis(star: Star) -> DataFrame:
    """All customers, those active since a date, those long gone, mean spend."""
    active = (
        order_revenue(star, "customer_id", "order_date")
        .where(F.col("order_date") >= F.lit(star.params.active_since))
        .where("customer_id IS NOT NULL").select("customer_id").distinct().agg(F.count("*"))
        .scalar()
    )
    everyone = star.customers.agg(F.count_distinct("customer_id")).scalar()
    gone = F.col("recency") > star.params.churn_days[0]
    return (
        rfm_base(star)
        .agg(
            F.count(F.when(gone, 1)).alias("churned_customers"), F.sum("monetary").alias("s"),
            F.count("*").alias("n"),
        )
        .withColumns({"total_customers": everyone, "active_customers": active})
        .select(
            "total_customers", "active_customers", "churned_customers",
            ratio(dollars("s"), "n", places=2).alias("avg_customer_value"),
        )
    )


def segment_revenue(star: Star) -> DataFrame:
    """Customers and revenue by segment, smallest first."""
    return segment_summary(star).select(
        "segment", "customers", F.col("total_revenue").alias("total_rev")
    ).orderBy("total_rev", "segment")


def page_distributions(star: Star) -> DataFrame:
    """The three histograms in 30 bins."""
    return rfm_distributions(star, 30)


def new_returning_pivot(star: Star) -> DataFrame:
    """P10: new and returning revenue by month, side by side."""
    return pivot_values(
        q11(star), ["month"], "customer_type", ["New", "Returning"], F.first("revenue"), 0.0
    ).select(
        "month", F.col("New").alias("new_revenue"), F.col("Returning").alias("returning_revenue")
    ).orderBy("month")


def returns_kpis(star: Star) -> DataFrame:
    """Units over all lines, returns, refunds and the mean refund."""
    units = star.order_items.agg(F.sum("quantity")).scalar()
    return (
        star.refunds.agg(
            F.count("*").alias("total_returns"), F.sum("refund").alias("s"),
            F.count("refund").alias("n"),
        )
        .withColumn("units_sold", units)
        .select(
            "units_sold", "total_returns", dollars("s").alias("total_refunds"),
            ratio(dollars("s"), "n", places=2).alias("avg_refund"),
        )
    )


def top_products_by_id(star: Star, n: int = 15) -> DataFrame:
    """Products with the most revenue."""
    products = star.products.select("product_id", "product_name", "category")
    top = top_n(_per_product(star).join(products, "product_id"), n, "revenue", ["product_id"])
    return top.select(
        "product_id", "product_name", "category", dollars("revenue").alias("revenue"), "units"
    ).orderBy(F.desc("revenue"), "product_id")


def margin_against_average(star: Star) -> DataFrame:
    """Category margin with its rank, and whether it reaches the mean of the margins."""
    mean = F.avg("margin_pct").over(Window.partitionBy())
    return category_metrics(star).select(
        "category", "margin_pct", rank_by("margin_pct").alias("margin_rank"),
        round_half(mean, 4).alias("avg_margin_pct"),
        (round_half(F.col("margin_pct") - mean, 6) >= 0).alias("reaches_average"),
    ).orderBy("margin_pct", "category")


def return_rate_against_average(star: Star) -> DataFrame:
    """Category return rate, and whether it is above the mean of the rates."""
    mean = F.avg("return_rate").over(Window.partitionBy())
    return return_rate_by_category(star).select(
        "category", "return_rate", round_half(mean, 4).alias("avg_return_rate"),
        (round_half(F.col("return_rate") - mean, 6) > 0).alias("above_average"),
    ).orderBy("return_rate", "category")


def revenue_by(star: Star, dimension: str) -> DataFrame:
    """Revenue by category, year or channel, on the inner-join fact."""
    if dimension == "category":
        base = _per_category(star).select("category", dollars("revenue").alias("revenue"))
    else:
        key = F.year("order_date") if dimension == "year" else F.col(dimension)
        base = (
            order_revenue(star, "order_date", "channel").where(key.isNotNull())
            .groupBy(key.alias(dimension)).agg(dollars(F.sum("revenue")).alias("revenue"))
        )
    return base.orderBy(dimension)
