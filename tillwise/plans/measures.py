"""Report measures under grouping and slicers, and time intelligence on a calendar.

``measures(star, names, by, spec)`` answers M01-M12, M23, M26 and M28-M30 for any grouping. Grouped by
order attributes, orders count whether or not they have lines. Grouped or sliced by product
attributes, orders are those with such a line.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions import (
    day_name, dollars, month_start, ratio, round_half, week_number, year_month,
)
from tillwise.operators.distinct import cell_counts, distinct_rollup, merge_cells
from tillwise.operators.star import (
    SLICER_COLUMNS, SliceSpec, Star, apply_slice, reaches, revenue_orders, slice_reaching, with_profit, with_tables,
)
from tillwise.operators.windows import share_of_total, top_n
from tillwise.plans.eda import return_rate_by_category
from tillwise.plans.queries import churn, state_revenue
from tillwise.plans.segments import abc_classes, product_abc, rfm

PRODUCT_ATTRIBUTES = ("product_id", "product_name", "category", "sub_category", "brand", "abc_class")
CUSTOMER_ATTRIBUTES = ("loyalty_tier", "segment")


def _sliced_columns(spec: SliceSpec | None) -> set[str]:
    if spec is None:
        return set()
    return {col for slicer, col in SLICER_COLUMNS.items() if getattr(spec, slicer) is not None}


def _orders_with(star: Star, wanted: set[str]) -> DataFrame:
    """Orders with year and month, plus state, loyalty tier or RFM segment where wanted."""
    orders = star.orders_geo if "state" in wanted else star.orders
    cols = ["order_id", "customer_id", "order_date", "channel", "status"]
    cols += [c for c in ("state",) if c in wanted] + [c for c in ("order_month",) if c in orders.columns]
    orders = orders.select(
        *cols, F.year("order_date").alias("year"), month_start("order_date").alias("month")
    )
    if "loyalty_tier" in wanted:
        tiers = star.customers.select("customer_id", "loyalty_tier")
        orders = orders.join(tiers, "customer_id", "left")
    if "segment" in wanted:
        orders = orders.join(rfm(star).select("customer_id", "segment"), "customer_id", "left")
    return orders


def _with_month_text(df: DataFrame) -> DataFrame:
    """Groups are formed by the month's first day; the result shows it as 'yyyy-MM'."""
    return df.withColumn("month", year_month("month")) if "month" in df.columns else df


def _product_columns(star: Star, wanted: set[str], cost: bool = True) -> DataFrame:
    products = product_abc(star) if "abc_class" in wanted else star.costs
    extra = [c for c in PRODUCT_ATTRIBUTES if c in wanted and c != "product_id"]
    return products.select("product_id", *(["cost"] if cost else []), *extra)


_SUMS = ("revenue", "cost", "units", "discount")
_COUNTS = ("orders", "completed", "line_orders", "customers")


def _line_sums(need: set[str]) -> dict[str, Column]:
    given = (F.col("quantity") * F.col("price")).cast("decimal(18,0)") * F.col("discount_pct")
    sums = {
        "revenue": lambda: F.sum("amount"), "cost": lambda: F.sum("line_cost"),
        "units": lambda: F.sum("quantity"), "discount": lambda: F.sum(given),
    }
    return {name: sums[name]().alias(name) for name in _SUMS if name in need}


def base_sums(
    star: Star, by: Sequence[str] = (), spec: SliceSpec | None = None,
    need: Sequence[str] = (*_SUMS, *_COUNTS), blank: bool = False,
) -> DataFrame:
    """Additive parts of the measures per group: those of ``need``.

    Out of revenue, cost, units, discount, orders, completed, line_orders, customers. Lines are
    read only for what is made of them or for product attributes, products only for the cost and
    those attributes, and customers form groups only where they are counted. With ``blank`` orders without a
    customer count as one customer more.
    """
    by, need = list(by), set(need)
    wanted = set(by) | _sliced_columns(spec)
    by_product = bool(wanted & set(PRODUCT_ATTRIBUTES))
    sums = _line_sums(need)
    orders = _orders_with(star, wanted)
    if not (sums or by_product or "line_orders" in need):
        per_order = apply_slice(orders, spec)
        has_lines = F.lit(None)
    else:
        lines = star.lines
        if by_product:
            lines = lines.join(_product_columns(star, wanted, "cost" in need), "product_id", "left")
        elif "cost" in need:
            lines = lines.join(_product_columns(star, wanted), "product_id", "left")
        if "cost" in need:
            lines = with_profit(lines)
        if by_product:
            joined = apply_slice(lines.join(orders, "order_id"), spec)
            if not need & set(_COUNTS):  # nothing is counted by order
                return _with_month_text(joined.groupBy(*by).agg(*sums.values()))
            per_order = joined.groupBy(
                *dict.fromkeys(["order_id", "customer_id", "status", *by])
            ).agg(*[*sums.values(), F.count("*").alias("n")])
            has_lines = F.lit(1)
        else:
            totals = lines.groupBy("order_id").agg(*[*sums.values(), F.count("*").alias("n")])
            per_order = apply_slice(orders, spec).join(totals, "order_id", "left")
            has_lines = F.when(F.col("n").isNotNull(), 1)
    completed = F.col("status").isin(*star.params.revenue_statuses)
    counts = {
        "orders": F.count("*"), "completed": F.count(F.when(completed, 1)),
        "line_orders": F.count(has_lines),
    }
    parts = [F.sum(c).alias(c) for c in sums] + [
        c.alias(name) for name, c in counts.items() if name in need
    ]
    if "customers" not in need:
        # Groups are those of all orders, so that one is formed even where nothing is added up.
        return _with_month_text(per_order.groupBy(*by).agg(*parts))
    per_customer = per_order.groupBy(*dict.fromkeys([*by, "customer_id"])).agg(
        *(parts or [F.count("*").alias("_any")])
    )
    added = [F.sum(c).alias(c) for c in (*sums, *[n for n in counts if n in need])]
    return _with_month_text(
        per_customer.groupBy(*by).agg(*added, F.count(F.lit(1) if blank else "customer_id").alias("customers"))
    )


def return_sums(star: Star, by: Sequence[str] = (), spec: SliceSpec | None = None) -> DataFrame:
    """Returns and refunds per group, by attributes of the returned order or product."""
    by = list(by)
    wanted = set(by) | _sliced_columns(spec)
    returned = star.refunds.groupBy("order_id", "product_id").agg(
        F.count("*").alias("returns"), F.sum("refund").alias("refund"),
        F.count("refund").alias("refunds"),
    )
    if wanted & set(PRODUCT_ATTRIBUTES):
        returned = returned.join(
            _product_columns(star, wanted).drop("cost"), "product_id", "left"
        )
    dated = spec is not None and bool(spec.years or spec.date_from or spec.date_to)
    if dated or wanted - set(PRODUCT_ATTRIBUTES):
        returned = returned.join(_orders_with(star, wanted), "order_id")
    return _with_month_text(
        apply_slice(returned, spec).groupBy(*by)
        .agg(*[F.sum(c).alias(c) for c in ("returns", "refund", "refunds")])
    )


# name -> expression over the columns of base_sums / return_sums / customer count
MEASURES = {
    "total_revenue": lambda: dollars("revenue"),
    "total_cost": lambda: dollars("cost"),
    "gross_profit": lambda: dollars(F.col("revenue") - F.coalesce("cost", F.lit(0))),
    "profit_margin": lambda: round_half(
        ratio(
            dollars(F.col("revenue") - F.coalesce("cost", F.lit(0))), dollars("revenue"),
            default=0.0,
        ), 4),
    "total_discount": lambda: round_half(dollars("discount"), 2),
    "average_order_value": lambda: ratio(dollars("revenue"), "orders", places=2, default=0.0),
    "revenue_per_customer": lambda: ratio(dollars("revenue"), "customers", places=2, default=0.0),
    "revenue_per_unit": lambda: ratio(dollars("revenue"), "units", places=4, default=0.0),
    "total_orders": lambda: F.col("orders"),
    "units_sold": lambda: F.col("units"),
    "completed_orders": lambda: F.col("completed"),
    "avg_items_per_order": lambda: ratio("units", "line_orders", places=4, default=0.0),
    "total_customers": lambda: F.col("all_customers"),
    "avg_customer_lifetime_value": lambda: ratio(
        dollars("revenue"), "all_customers", places=2, default=0.0),
    "total_returns": lambda: F.coalesce("returns", F.lit(0)),
    "return_rate": lambda: ratio(
        F.coalesce("returns", F.lit(0)), "completed", places=4, default=0.0),
    "total_refund": lambda: dollars("refund"),
    "avg_refund": lambda: ratio(dollars("refund"), "returns", places=2),
}
_OF_RETURNS = {"total_returns", "return_rate", "total_refund", "avg_refund"}
_OF_CUSTOMERS = {"total_customers", "avg_customer_lifetime_value"}
# name -> the parts of base_sums that it is made of
_NEEDS = {
    "total_revenue": ("revenue",), "total_cost": ("cost",), "gross_profit": ("revenue", "cost"),
    "profit_margin": ("revenue", "cost"), "total_discount": ("discount",),
    "average_order_value": ("revenue", "orders"), "revenue_per_customer": ("revenue", "customers"),
    "revenue_per_unit": ("revenue", "units"), "total_orders": ("orders",), "units_sold": ("units",),
    "completed_orders": ("completed",), "avg_items_per_order": ("units", "line_orders"),
    "total_customers": ("orders",), "avg_customer_lifetime_value": ("revenue",),
    "total_returns": ("orders",), "return_rate": ("completed",), "total_refund": ("orders",),
    "avg_refund": ("orders",),
}


def _model_sums(star: Star, by: list[str], spec: SliceSpec | None, need: set[str]) -> DataFrame:
    """``base_sums`` as the report model's filters give them.

    Each table is filtered and grouped by what reaches it along the relationships: a product filter reaches order lines and
    returns but no orders, so orders, completed orders and customers are then those of all products, the same for each group of a
    column that does not reach them. Orders without a customer count as one customer, the blank one. Groups
    are those of the order lines.
    """
    of_orders = need & {"orders", "completed", "customers"}
    lines = base_sums(star, by, slice_reaching(spec, "order_items"), (need - of_orders) or {"revenue"})
    if not of_orders:
        return lines
    own = [b for b in by if reaches(b, "orders")]
    orders = base_sums(star, own, slice_reaching(spec, "orders"), of_orders, blank=True)
    if not own:
        row = orders.select(F.struct(*sorted(of_orders))).scalar()
        return lines.drop(*of_orders).withColumn("_o", row).select("*", "_o.*").drop("_o")
    keyed = orders.select(*[F.col(b).alias(f"_{b}") for b in own], *sorted(of_orders))
    same = [lines[b].eqNullSafe(keyed[f"_{b}"]) for b in own]
    return lines.drop(*of_orders).join(keyed, same, "left").drop(*[f"_{b}" for b in own])


def measures(
    star: Star, names: Sequence[str], by: Sequence[str] = (), spec: SliceSpec | None = None, model_filters: bool = False
) -> DataFrame:
    """The named measures per group, under the slicers.

    ``model_filters`` follows the report model's one-way relationships (``RELATIONSHIPS``); otherwise all figures are those of the same lines.
    """
    by = list(by)
    if set(names) == {"total_customers"} and not by and spec is None:
        return star.customers.agg(F.count_distinct("customer_id").alias("total_customers"))
    need = {part for name in names for part in _NEEDS[name]}
    df = _model_sums(star, by, spec, need) if model_filters else base_sums(star, by, spec, need)
    if _OF_RETURNS & set(names):
        returned = return_sums(star, by, spec)
        if by:
            keyed = returned.select(
                *[F.col(b).alias(f"_{b}") for b in by], "returns", "refund", "refunds"
            )
            same = [df[b].eqNullSafe(keyed[f"_{b}"]) for b in by]
            df = df.join(keyed, same, "left")
        else:
            row = returned.select(F.struct("returns", "refund", "refunds")).scalar()
            df = df.withColumn("_r", row).select("*", "_r.*")
    if _OF_CUSTOMERS & set(names):
        everyone = star.customers.agg(F.count_distinct("customer_id")).scalar()
        df = df.withColumn("all_customers", everyone)
    return df.select(*by, *[MEASURES[n]().alias(n) for n in names])


# --- calendar ----------------------------------------------------------------------------

def date_dimension(star: Star) -> DataFrame:
    """One row per day from the first to the last order date."""
    return calendar_columns(
        star.orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
        .where("lo IS NOT NULL")
        .select(F.explode(F.sequence("lo", "hi")).alias("date"))
    )


def calendar_columns(days: DataFrame) -> DataFrame:
    d = F.col("date")
    quarter = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    weekday = F.weekday(d) + 1
    return days.select(
        "date", F.year(d).alias("year"), F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_short"),
        quarter.alias("quarter"), year_month(d).alias("year_month"),
        F.concat(F.date_format(d, "yyyy"), F.lit(" "), quarter).alias("year_quarter"),
        weekday.alias("day_of_week"), day_name(d).alias("day_name"),
        F.when(weekday >= 6, "Weekend").otherwise("Weekday").alias("is_weekend"),
        week_number(d).alias("week_number"),
    )


def month_spine(star: Star) -> DataFrame:
    """Every month from the first to the last order, and its last calendar date."""
    ends = star.orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    months = F.explode(
        F.sequence(month_start("lo"), month_start("hi"), F.expr("interval 1 month"))
    )
    return ends.where("lo IS NOT NULL").select(months.alias("m"), "hi").select(
        "m", F.least(F.last_day("m"), F.col("hi")).alias("anchor")
    )


def monthly_series(star: Star, spec: SliceSpec | None = None, profit: bool = True) -> DataFrame:
    """M13-M22 and M35 per calendar month; months without revenue stay in the series.

    Shifts go by calendar month, unlike the row-based growth query. The series is as long as
    the calendar, so its window runs in one small task. Without ``profit`` there is no margin
    in it, and no product is read.
    """
    per_month = base_sums(star, ["month"], spec, ("revenue", "cost") if profit else ("revenue",))
    cost = F.coalesce("cost", F.lit(0)) if profit else F.lit(0)
    per_month = per_month.select(
        F.col("month").alias("ym"), "revenue", (F.col("revenue") - cost).alias("profit"),
    )
    spine = month_spine(star).select("m", year_month("m").alias("ym"))
    w = Window.orderBy("m")
    year = Window.partitionBy(F.year("m")).orderBy("m")

    def trailing(col: str, months: int) -> Column:
        return F.sum(col).over(w.rowsBetween(-(months - 1), 0))

    def change(previous: str) -> Column:
        return F.coalesce("revenue", F.lit(0)) - F.coalesce(previous, F.lit(0))

    target = F.lit(float(star.params.monthly_target))
    series = (
        spine.join(per_month, "ym", "left")
        .withColumns({
            "prev": F.lag("revenue").over(w), "sply": F.lag("revenue", 12).over(w),
            "ytd": F.sum("revenue").over(year), "r3": trailing("revenue", 3),
            "p3": trailing("profit", 3), "r12": trailing("revenue", 12),
        })
        .select(
            F.col("ym").alias("month"), dollars("revenue").alias("revenue"),
            dollars("prev").alias("revenue_prev_month"),
            dollars(change("prev")).alias("mom_change"),
            ratio(dollars(change("prev")), dollars("prev"), places=6).alias("mom_growth"),
            dollars("sply").alias("revenue_sply"),
            ratio(dollars(change("sply")), dollars("sply"), places=6).alias("yoy_growth"),
            dollars("ytd").alias("revenue_ytd"), dollars("r3").alias("rolling_3m_revenue"),
            dollars("r12").alias("rolling_12m_revenue"),
            ratio(dollars("p3"), dollars("r3"), places=6, default=0.0).alias("rolling_3m_margin"),
            round_half(
                dollars(F.coalesce("revenue", F.lit(0))) - dollars("r12") / 12.0
            ).alias("revenue_vs_12m_avg"),
            round_half(F.coalesce(dollars("revenue"), F.lit(0.0)) / target, 6)
            .alias("target_achievement"),
        )
    )
    return series if profit else series.drop("rolling_3m_margin")


def time_measure(star: Star, name: str, spec: SliceSpec | None = None) -> DataFrame:
    """One column of the monthly series."""
    margin = name == "rolling_3m_margin"
    return monthly_series(star, spec, margin).select("month", name).orderBy("month")


def active_customers(star: Star, grain: str = "month") -> DataFrame:
    """Customers with a revenue order in the 90 days up to each month's last date, or up to each day.

    A sweep: an order keeps its customer active from its day until the customer's next order or for 90 days, whichever ends first, so
    that the spans of a customer never overlap. Each span is one +1 on its first day and one -1 behind its last; these
    events add up by day, and their running sum over the calendar is the number of active customers.
    """
    if grain not in ("day", "month"):
        raise ValueError("grain is 'day' or 'month'")
    days = star.params.active_days
    following = F.lead("order_date").over(Window.partitionBy("customer_id").orderBy("order_date"))
    spans = (
        star.orders.where(F.col("status").isin(*star.params.revenue_statuses))
        .where("customer_id IS NOT NULL AND order_date IS NOT NULL")
        .select("customer_id", "order_date").withColumn("next", following)
        .select("order_date", F.least("next", F.date_add("order_date", days)).alias("end"))
    )
    events = spans.select(F.explode(F.array(
        F.struct(F.col("order_date").alias("date"), F.lit(1).alias("change")), F.struct(F.col("end").alias("date"), F.lit(-1).alias("change")),
    )).alias("e")).groupBy("e.date").agg(F.sum("e.change").alias("change"))
    calendar = (
        star.orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).where("lo IS NOT NULL")
        .select(F.explode(F.sequence("lo", "hi")).alias("date"), "hi")
    )
    running = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)  # as long as the calendar
    per_day = calendar.join(events, "date", "left").select(
        "date", "hi", F.sum(F.coalesce("change", F.lit(0))).over(running).alias("active_customers")
    )
    if grain == "day":
        return per_day.select("date", "active_customers").orderBy("date")
    return per_day.where(F.col("date") == F.least(F.last_day("date"), F.col("hi"))).select(
        year_month("date").alias("month"), "active_customers"
    ).orderBy("month")


def customers_by_period(star: Star) -> DataFrame:
    """Customers of revenue orders by month, quarter and year, for each channel and in all.

    One rollup by (month, channel) holds a bitmap for each cell; coarser periods and all channels are merged from finer
    ones, and no customer is looked at again.
    """
    seen = revenue_orders(star, "customer_id", "order_date", "channel").where("order_date IS NOT NULL").withColumn(
        "month", month_start("order_date")
    )
    months = distinct_rollup(seen, ["month", "channel"], "customer_id")
    quarters = merge_cells(months.withColumn("quarter", F.trunc("month", "quarter")), ["quarter", "channel"])
    years = merge_cells(quarters.withColumn("year", F.trunc("quarter", "year")), ["year", "channel"])
    parts = []
    for grain, cut in (("month", months), ("quarter", quarters), ("year", years)):
        for of in (cell_counts(cut, [grain, "channel"], "customers"),
                   cell_counts(merge_cells(cut, [grain]), [grain], "customers").withColumn("channel", F.lit(None).cast("string"))):
            parts.append(of.select(F.lit(grain).alias("grain"), F.col(grain).alias("start"), "channel", "customers"))
    return reduce(DataFrame.unionByName, parts)


def new_customers(star: Star) -> DataFrame:
    """Customers by the month of their first order of any status."""
    firsts = (
        star.orders.where("customer_id IS NOT NULL").groupBy("customer_id")
        .agg(F.min("order_date").alias("first")).where("first IS NOT NULL")
    )
    return (
        firsts.groupBy(month_start("first").alias("m"))
        .agg(F.count("*").alias("new_customers"))
        .select(year_month("m").alias("month"), "new_customers").orderBy("month")
    )


def retention_rate(star: Star) -> DataFrame:
    """Share of customers with more than one revenue order."""
    return rfm(star).agg(
        F.count(F.when(F.col("frequency") > 1, 1)).alias("repeat"), F.count("*").alias("n")
    ).select(ratio("repeat", "n", places=6, default=0.0).alias("retention_rate"))


def what_if(star: Star, by_month: bool = False, low: int = -20, high: int = 20) -> DataFrame:
    """Revenue under a price adjustment of -20 … 20 %, in total or by month."""
    base = base_sums(star, ["month"] if by_month else [], need=("revenue",))
    keys = ["month"] if by_month else []
    steps = base.select(
        *keys, dollars("revenue").alias("revenue"),
        F.explode(F.sequence(F.lit(low), F.lit(high))).alias("adjustment_pct"),
    )
    adjusted = F.col("revenue") * (F.lit(1.0) + F.col("adjustment_pct") / 100.0)
    return steps.select(
        *keys, "adjustment_pct", round_half(adjusted - F.col("revenue")).alias("revenue_impact"),
        round_half(adjusted).alias("adjusted_revenue"),
    ).orderBy(*keys, "adjustment_pct")


def category_revenue_share(star: Star) -> DataFrame:
    """Share of each category in revenue of every status."""
    return measures(star, ["total_revenue"], ["category"]).withColumn(
        "revenue_share", round_half(share_of_total("total_revenue"), 6)
    ).orderBy("category")


def segment_revenue_share(star: Star) -> DataFrame:
    """Share of each RFM segment in revenue of every status."""
    per_customer = (
        star.orders.select("order_id", "customer_id")
        .join(star.lines.groupBy("order_id").agg(F.sum("amount").alias("r")), "order_id")
        .groupBy("customer_id").agg(F.sum("r").alias("r"))
    )
    return (
        per_customer.join(rfm(star).select("customer_id", "segment"), "customer_id", "left")
        .groupBy("segment").agg(dollars(F.sum("r")).alias("total_revenue"))
        .withColumn("revenue_share", round_half(share_of_total("total_revenue"), 6))
        .orderBy("segment")
    )


def _sales(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id").agg(F.sum("amount").alias("revenue"), F.sum("quantity").alias("units"))


def product_detail(star: Star, category: str, n: int = 10) -> DataFrame:
    """Top products of one category with margin, and the category's return rate.

    Only lines of the category's products are added up.
    """
    own = with_tables(star, products=star.products.where(F.col("category") == category))
    lines = own.lines.join(own.products.select("product_id"), "product_id", "left_semi")
    sales = _sales(lines).join(
        own.costs.select("product_id", "cost", "product_name", "brand", "category"), "product_id"
    ).withColumn("cost", F.col("units") * F.col("cost"))
    rates = return_rate_by_category(own).select("category", "return_rate")
    return (
        top_n(sales, n, "revenue", ["product_id"]).join(rates, "category", "left")
        .select(
            "category", "product_id", "product_name", "brand",
            dollars("revenue").alias("revenue"), "units",
            ratio(dollars(F.col("revenue") - F.col("cost")), dollars("revenue"), 100.0, 2, 0.0)
            .alias("margin_pct"),
            F.col("return_rate").alias("category_return_rate"),
        )
        .orderBy(F.desc("revenue"), "product_id")
    )


def state_tooltip(star: Star) -> DataFrame:
    """Revenue, orders, customers and order value by state."""
    return state_revenue(star).select(
        "state", dollars("r").alias("total_revenue"), "total_orders",
        F.col("unique_customers").alias("customers"),
        ratio(dollars("r"), "total_orders", places=2).alias("avg_order_value"),
    ).orderBy("state")


def churn_risk(star: Star) -> DataFrame:
    """Customers past the shorter churn limit, and the mean refund per return."""
    refund = star.refunds.agg(
        F.struct(F.sum("refund").alias("s"), F.count("*").alias("n"))
    ).scalar()
    return (
        churn(star).where(F.col("days_since_last_order") > star.params.churn_days[1])
        .agg(F.count("*").alias("churn_risk_customers"))
        .withColumn("r", refund)
        .select("churn_risk_customers", ratio(dollars("r.s"), "r.n", places=2).alias("avg_refund"))
    )


def product_table(star: Star, n: int = 20) -> DataFrame:
    """The strongest products with units, margin and value class; lines are added up once for sales and classes."""
    sales = star.costs.select("product_id", "cost", "product_name").join(_sales(star.lines), "product_id", "left").withColumn(
        "revenue", F.coalesce("revenue", F.lit(0).cast("bigint"))
    )
    classed = abc_classes(sales, star.params.abc_cuts).where("units IS NOT NULL").withColumn("cost", F.col("units") * F.col("cost"))
    return top_n(classed, n, "revenue", ["product_id"]).select(
        "product_id", "product_name", dollars("revenue").alias("revenue"), "units",
        ratio(dollars(F.col("revenue") - F.col("cost")), dollars("revenue"), 100.0, 2, 0.0).alias("margin_pct"),
        "abc_class",
    ).orderBy(F.desc("revenue"), "product_id")
