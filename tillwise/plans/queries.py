"""The 22 named business queries.

Shape shared by most of them: lines are added up per order, joined to the revenue orders on
order_id, and grouped from there. An order is one row from then on, so orders are counted, not
counted distinct; customers are counted by grouping once more by customer, which combines on
the map side. Money is added in whole cents, which is exact, and leaves as DOUBLE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions import (
    bucketize, dollars, label_at, month_index, month_start, ratio, year_month,
)
from tillwise.operators.affinity import top_pairs
from tillwise.operators.star import (
    Star, costed_lines, costed_order_totals, order_revenue, order_totals, revenue_lines,
    revenue_orders, with_profit,
)
from tillwise.operators.windows import (
    growth, rank_by, rolling_days, rolling_rows, running_total, top_n,
)
from tillwise.schema import (
    CHURN_LABELS, CLV_LABELS, DISCOUNT_LABELS, FREQUENCY_LABELS, WEEKDAY_LABELS,
)


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """NULL when either part is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def monthly_revenue(star: Star) -> DataFrame:
    """(month 'yyyy-MM', revenue) of revenue orders that have a date.

    Grouped by the date of the month's first day; text is made of the few groups only.
    """
    return (
        order_revenue(star, "order_date").where("order_date IS NOT NULL")
        .groupBy(month_start("order_date").alias("m"))
        .agg(F.sum("revenue").alias("revenue"))
        .select(year_month("m").alias("month"), "revenue")
    )


def daily_revenue(star: Star) -> DataFrame:
    return (
        order_revenue(star, "order_date").where("order_date IS NOT NULL")
        .groupBy("order_date").agg(F.sum("revenue").alias("daily_revenue"))
    )


def category_orders(star: Star, *sums: Column) -> DataFrame:
    """Per category: total_orders and the given sums over revenue lines.

    The step per (order, category) keeps the partitioning by order that the join left, and
    turns the distinct count into a count.
    """
    lines = revenue_lines(star, products=star.costs.select("product_id", "category", "cost"))
    return (
        with_profit(lines).groupBy("order_id", "category")
        .agg(F.sum("amount").alias("revenue"), F.sum("line_profit").alias("profit"))
        .groupBy("category")
        .agg(F.count("*").alias("total_orders"), *sums)
    )


def q01(star: Star) -> DataFrame:
    """Revenue by year and order status (every status)."""
    orders = star.orders.where("order_date IS NOT NULL").select(
        "order_id", "status", F.year("order_date").alias("year")
    )
    return (
        orders.join(costed_order_totals(star), "order_id")
        .groupBy("year", "status")
        .agg(
            F.count("*").alias("total_orders"), F.sum("revenue").alias("r"),
            F.sum("profit").alias("p"), F.sum("lines").alias("n"),
        )
        .select(
            F.col("year").cast("string").alias("year"), "status", "total_orders",
            dollars("r").alias("gross_revenue"),
            dollars("p").alias("gross_profit"),
            ratio(dollars("r"), "n", places=2).alias("avg_line_value"),
            ratio(dollars("r"), "total_orders", places=2).alias("avg_order_value"),
        )
        .orderBy("year", F.desc("gross_revenue"), "status")
    )


def q02(star: Star) -> DataFrame:
    """Month-over-month growth; the previous row is the previous month that has revenue."""
    monthly = monthly_revenue(star).withColumn("revenue", dollars("revenue"))
    return growth(
        monthly, "revenue", "month", "prev_month_revenue", "mom_change", "mom_growth_pct"
    ).orderBy("month")


def category_year_revenue(star: Star) -> DataFrame:
    """(category, year, revenue): added up per product before the category is looked up."""
    per_product = (
        revenue_lines(star, "order_date").where("order_date IS NOT NULL")
        .groupBy("product_id", F.year("order_date").alias("year"))
        .agg(F.sum("amount").alias("revenue"))
    )
    return (
        per_product.join(star.products.select("product_id", "category"), "product_id")
        .groupBy("category", "year").agg(dollars(F.sum("revenue")).alias("revenue"))
        .withColumn("year", F.col("year").cast("string"))
    )


def q03(star: Star) -> DataFrame:
    """Year-over-year revenue by category."""
    return growth(
        category_year_revenue(star), "revenue", "year", "prev_year_revenue",
        growth_pct="yoy_growth_pct", partition_by="category",
    ).orderBy("category", "year")


def q04(star: Star) -> DataFrame:
    """Running total and three-month mean of monthly revenue."""
    return monthly_revenue(star).select(
        "month", dollars("revenue").alias("revenue"),
        dollars(running_total("revenue", "month")).alias("cumulative_revenue"),
        ratio(
            dollars(rolling_rows("revenue", 3, "month", F.sum)),
            rolling_rows("revenue", 3, "month", F.count), places=2,
        ).alias("rolling_3m_avg"),
    ).orderBy("month")


def rolling_revenue(star: Star, days: int) -> DataFrame:
    total = rolling_days("daily_revenue", days, "order_date")
    return daily_revenue(star).select(
        "order_date", dollars("daily_revenue").alias("daily_revenue"),
        dollars(total).alias(f"rolling_{days}d_revenue"),
        rolling_days("order_date", days, "order_date", F.count).alias("days_in_window"),
    ).orderBy("order_date")


def q05(star: Star, days: int = 30) -> DataFrame:
    """Revenue of the last 30 calendar days, for each day that has revenue."""
    return rolling_revenue(star, days).drop("days_in_window")


def q06(star: Star, days: int = 90) -> DataFrame:
    """Revenue of the last 90 calendar days, and how many of them had revenue."""
    return rolling_revenue(star, days)


def category_metrics(star: Star) -> DataFrame:
    return category_orders(
        star, F.sum("revenue").alias("r"), F.sum("profit").alias("p")
    ).select(
        "category", dollars("r").alias("revenue"), dollars("p").alias("gross_profit"),
        ratio(dollars("p"), dollars("r"), 100.0, 2).alias("margin_pct"), "total_orders",
    )


def q07(star: Star) -> DataFrame:
    """Categories ranked by revenue, by margin and by orders (undated orders count)."""
    return category_metrics(star).select(
        "*",
        rank_by("revenue").alias("revenue_rank"),
        rank_by("margin_pct").alias("margin_rank"),
        rank_by("total_orders").alias("volume_rank"),
    ).orderBy("revenue_rank", "category")


def q08(star: Star, n: int = 5) -> DataFrame:
    """Top products per category by dense rank; products of one name and brand are one."""
    named = ["category", "product_name", "brand"]
    products = star.products.select("product_id", *named)
    return (
        revenue_lines(star, products=products)
        .groupBy("order_id", *named)
        .agg(F.sum("amount").alias("revenue"), F.sum("quantity").alias("units"))
        .groupBy(*named)
        .agg(
            dollars(F.sum("revenue")).alias("revenue"), F.sum("units").alias("units_sold"),
            F.count("*").alias("order_count"),
        )
        .withColumn("rank_in_category", rank_by("revenue", "dense_rank", "category"))
        .where(F.col("rank_in_category") <= n)
        .orderBy("category", "rank_in_category", "product_name", "brand")
    )


def customer_revenue(star: Star) -> DataFrame:
    """Per customer with revenue: orders, lines, revenue, first and last order date."""
    return (
        order_revenue(star, "customer_id", "order_date").where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_orders"), F.sum("lines").alias("lines"),
            F.sum("revenue").alias("revenue"), F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def _named_customers(star: Star) -> DataFrame:
    return star.customers.select(
        "customer_id", full_name().alias("customer_name"), "loyalty_tier", "state"
    )


def clv_label(value: Column | str, cuts: Sequence[float]) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    chain = F.when(value >= cuts[0], CLV_LABELS[0])
    for cut, label in zip(cuts[1:], CLV_LABELS[1:]):
        chain = chain.when(value >= cut, label)
    return chain.otherwise(CLV_LABELS[-1])


def q09(star: Star) -> DataFrame:
    """Customer lifetime value; the average is per order line."""
    return (
        customer_revenue(star).join(_named_customers(star), "customer_id")
        .select(
            "customer_id", "customer_name", "loyalty_tier", "state", "total_orders",
            dollars("revenue").alias("lifetime_value"),
            ratio(dollars("revenue"), "lines", places=2).alias("avg_order_value"),
            "first_order_date", "last_order_date",
            F.date_diff("last_order_date", "first_order_date").alias("customer_tenure_days"),
        )
        .withColumn("clv_segment", clv_label("lifetime_value", star.params.clv_cuts))
        .orderBy(F.desc("lifetime_value"), "customer_id")
    )


def churn_label(days: Column | str, limits: Sequence[int]) -> Column:
    days = F.col(days) if isinstance(days, str) else days
    return (
        F.when(days > limits[0], CHURN_LABELS[0]).when(days > limits[1], CHURN_LABELS[1])
        .otherwise(CHURN_LABELS[2])
    )


def churn(star: Star) -> DataFrame:
    last = (
        revenue_orders(star, "customer_id", "order_date").where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.max("order_date").alias("last_order_date"), F.count("*").alias("total_orders"))
    )
    days = F.date_diff(F.lit(star.params.as_of), F.col("last_order_date"))
    return last.join(_named_customers(star), "customer_id").select(
        "customer_id", "customer_name", "loyalty_tier", "state", "last_order_date",
        "total_orders", days.alias("days_since_last_order"),
        churn_label(days, star.params.churn_days).alias("churn_status"),
    )


def q10(star: Star) -> DataFrame:
    """Churn flags at the as-of date; a customer without a dated order counts as active."""
    return churn(star).orderBy(F.desc_nulls_last("days_since_last_order"), "customer_id")


def customer_periods(star: Star, period: Column) -> DataFrame:
    """Revenue orders per customer and period, with the customer's first period.

    The first period is over orders of any status. Orders fold into one row per customer and
    period before the window, so a customer with very many orders stays a small group.
    """
    orders = star.orders.where("customer_id IS NOT NULL").select(
        "order_id", "customer_id", period.alias("period"),
        F.col("status").isin(*star.params.revenue_statuses).alias("counts"),
    )
    sold = F.col("counts") & F.col("lines").isNotNull()
    return (
        orders.join(order_totals(star.lines), "order_id", "left")
        .groupBy("customer_id", "period")
        .agg(
            F.count(F.when(sold, 1)).alias("orders"),
            F.sum(F.when(sold, F.col("revenue"))).alias("revenue"),
        )
        .withColumn("first_period", F.min("period").over(Window.partitionBy("customer_id")))
        .where("orders > 0 AND period IS NOT NULL")
    )


def q11(star: Star) -> DataFrame:
    """New and returning customers by month; every order of the first day is new."""
    kind = F.when(F.col("period") == F.col("first_period"), "New").otherwise("Returning")
    return (
        customer_periods(star, F.col("order_date"))
        .groupBy("customer_id", month_start("period").alias("m"), kind.alias("customer_type"))
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
        .groupBy("m", "customer_type")
        .agg(
            F.sum("orders").alias("orders"), F.count("*").alias("customers"),
            dollars(F.sum("revenue")).alias("revenue"),
        )
        .select(year_month("m").alias("month"), "customer_type", "orders", "customers", "revenue")
        .orderBy("month", "customer_type")
    )


def q12(star: Star) -> DataFrame:
    """Channel performance."""
    return (
        revenue_orders(star, "channel", "customer_id")
        .join(costed_order_totals(star), "order_id")
        .groupBy("channel", "customer_id")
        .agg(
            F.count("*").alias("orders"), F.sum("revenue").alias("r"),
            F.sum("profit").alias("p"), F.sum("discounts").alias("d"),
            F.sum("discount_lines").alias("n"),
        )
        .groupBy("channel")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count("customer_id").alias("unique_customers"), F.sum("r").alias("r"),
            F.sum("p").alias("p"), F.sum("d").alias("d"), F.sum("n").alias("n"),
        )
        .select(
            "channel", "total_orders", "unique_customers",
            dollars("r").alias("total_revenue"),
            ratio(dollars("r"), "total_orders", places=2).alias("avg_order_value"),
            dollars("p").alias("gross_profit"),
            ratio(dollars("p"), dollars("r"), 100.0, 2).alias("margin_pct"),
            ratio("d", "n", 100.0, 2).alias("avg_discount_pct"),
        )
        .orderBy(F.desc("total_revenue"), "channel")
    )


def channel_year_aov(star: Star) -> DataFrame:
    return (
        order_revenue(star, "channel", "order_date").where("order_date IS NOT NULL")
        .groupBy("channel", F.year("order_date").alias("year"))
        .agg(F.sum("revenue").alias("r"), F.count("*").alias("n"))
        .select("channel", F.col("year").cast("string").alias("year"), ratio(dollars("r"), "n", places=2).alias("aov"))
    )


def q13(star: Star) -> DataFrame:
    """Average order value by channel and year, with the next year's."""
    following = F.lead("aov").over(Window.partitionBy("channel").orderBy("year"))
    return (
        channel_year_aov(star).withColumn("next_year_aov", following)
        .withColumn(
            "yoy_aov_change_pct",
            ratio(F.col("next_year_aov") - F.col("aov"), "aov", 100.0, 2),
        )
        .orderBy("channel", "year")
    )


def q14(star: Star) -> DataFrame:
    """Return rate by category and reason, against the category's revenue orders."""
    returned = (
        star.refunds.groupBy("product_id", "reason")
        .agg(
            F.count("return_id").alias("n"), F.sum("refund").alias("refund"),
            F.count("refund").alias("refunds"),
        )
        .join(star.products.select("product_id", "category"), "product_id")
        .groupBy("category", "reason")
        .agg(
            F.sum("n").alias("return_count"), F.sum("refund").alias("refund"),
            F.sum("refunds").alias("refunds"),
        )
    )
    return (
        returned.join(category_orders(star), "category")
        .select(
            "category", "reason", "return_count", dollars("refund").alias("total_refund"),
            ratio(dollars("refund"), "refunds", places=2).alias("avg_refund"), "total_orders",
            ratio("return_count", "total_orders", 100.0, 2).alias("return_rate_pct"),
        )
        .orderBy(F.desc("return_count"), "category", "reason")
    )


def q15(star: Star) -> DataFrame:
    """How many customers order how often."""
    per_customer = (
        revenue_orders(star, "customer_id").where("customer_id IS NOT NULL")
        .groupBy("customer_id").agg(F.count("*").alias("order_count"))
    )
    bucket = bucketize("order_count", star.params.frequency_cuts, FREQUENCY_LABELS)
    buckets = per_customer.groupBy(bucket.alias("frequency_bucket")).agg(
        F.count("*").alias("customers"), F.sum("order_count").alias("orders"),
        F.min("order_count").alias("smallest"),
    )
    everyone = F.sum("customers").over(Window.partitionBy())
    return (
        buckets.select(
            "frequency_bucket", "customers",
            ratio("orders", "customers", places=1).alias("avg_orders_in_bucket"),
            ratio("customers", everyone, 100.0, 2).alias("pct_of_customers"), "smallest",
        )
        .orderBy("smallest").drop("smallest")
    )


def q16(star: Star, n: int = 20) -> DataFrame:
    """Largest customers by revenue, numbered after the cut."""
    found = customer_revenue(star).join(_named_customers(star), "customer_id")
    return top_n(found, n, "revenue", ["customer_id"], "rank").select(
        "rank", "customer_id", "customer_name", "loyalty_tier", "state", "total_orders",
        dollars("revenue").alias("lifetime_value"),
        F.col("first_order_date").alias("first_order"),
        F.col("last_order_date").alias("last_order"),
    ).orderBy("rank")


def q17(star: Star) -> DataFrame:
    """Revenue and margin by discount band; the lowest bound is inclusive."""
    cuts = [F.lit(c).cast("decimal(5,4)") for c in star.params.discount_cuts]
    band = bucketize("discount_pct", cuts, DISCOUNT_LABELS)
    lines = costed_lines(star).join(revenue_orders(star), "order_id", "left_semi")
    return (
        lines.groupBy(band.alias("discount_bucket"))
        .agg(
            F.count("*").alias("line_items"), F.sum("quantity").alias("units_sold"),
            F.sum("amount").alias("r"), F.sum("line_profit").alias("p"),
            F.count("amount").alias("n"), F.min("discount_pct").alias("smallest"),
        )
        .select(
            "discount_bucket", "line_items", "units_sold", dollars("r").alias("revenue"),
            dollars("p").alias("gross_profit"),
            ratio(dollars("p"), dollars("r"), 100.0, 2).alias("margin_pct"),
            ratio(dollars("r"), "n", places=2).alias("avg_line_value"), "smallest",
        )
        .orderBy("smallest").drop("smallest")
    )


def q18(star: Star) -> DataFrame:
    """Revenue of each first-order cohort over its first twelve months."""
    months = customer_periods(star, month_start("order_date"))
    return (
        months.withColumn("month_index", month_index("period", "first_period"))
        .where(F.col("month_index").between(0, star.params.cohort_months))
        .groupBy("first_period", "period", "month_index")
        .agg(F.sum("revenue").alias("r"), F.count("*").alias("active_customers"))
        .select(
            year_month("first_period").alias("cohort_month"),
            year_month("period").alias("order_month"), "month_index",
            dollars("r").alias("cohort_revenue"), "active_customers",
        )
        .orderBy("cohort_month", "month_index")
    )


def q19(star: Star) -> DataFrame:
    """Revenue by weekday, Monday first."""
    return (
        order_revenue(star, "order_date").where("order_date IS NOT NULL")
        .groupBy(F.weekday("order_date").alias("day"))
        .agg(F.count("*").alias("total_orders"), F.sum("revenue").alias("r"))
        .select(
            label_at("day", WEEKDAY_LABELS).alias("day_of_week"), "total_orders", dollars("r").alias("total_revenue"),
            ratio(dollars("r"), "total_orders", places=2).alias("avg_order_value"),
        )
        .orderBy("day_of_week")
    )


def q20(star: Star, n: int = 30) -> DataFrame:
    """Product pairs bought together most often (every status), by product names."""
    return top_pairs(star, n)


def q21(star: Star) -> DataFrame:
    """Revenue by loyalty tier of known customers."""
    customers = star.customers.select(
        "customer_id", F.coalesce("loyalty_tier", F.lit("Unknown")).alias("loyalty_tier")
    )
    return (
        customer_revenue(star).join(customers, "customer_id")
        .groupBy("loyalty_tier")
        .agg(
            F.count("*").alias("customers"), F.sum("total_orders").alias("total_orders"),
            F.sum("revenue").alias("r"),
        )
        .select(
            "loyalty_tier", "customers", "total_orders", dollars("r").alias("total_revenue"),
            ratio(dollars("r"), "customers", places=2).alias("revenue_per_customer"),
            ratio(dollars("r"), "total_orders", places=2).alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue_per_customer"), "loyalty_tier")
    )


def state_revenue(star: Star) -> DataFrame:
    """Per state of the order: orders, distinct customers, revenue."""
    return (
        order_revenue(star, "state", "customer_id", geo=True).where("state IS NOT NULL")
        .groupBy("state", "customer_id")
        .agg(F.count("*").alias("orders"), F.sum("revenue").alias("r"))
        .groupBy("state")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count("customer_id").alias("unique_customers"), F.sum("r").alias("r"),
        )
    )


def q22(star: Star) -> DataFrame:
    """Revenue by state of the order, ranked."""
    return state_revenue(star).select(
        "state", "total_orders", "unique_customers", dollars("r").alias("total_revenue"),
        ratio(dollars("r"), "unique_customers", places=2).alias("revenue_per_customer"),
        ratio(dollars("r"), "total_orders", places=2).alias("avg_order_value"),
        rank_by("r").alias("revenue_rank"),
    ).orderBy("revenue_rank", "state")
