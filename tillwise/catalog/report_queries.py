"""Registered exploratory, dashboard and measure queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tillwise.catalog.cleaning_queries import doubles
from tillwise.catalog.driver import DriverStar
from tillwise.functions import dollars, round_half
from tillwise.operators.star import SliceSpec
from tillwise.plans import cohort, dashboards as P, eda as E, measures as M, segments as S

Build = Callable[[DriverStar], DataFrame]

# The drill-through shows one category at a time.
DETAIL_CATEGORY = "ECONOMY"
ORDER_SLICE = SliceSpec(
    years=(1997, 1998, 1999), channels=("1-URGENT", "2-HIGH", "5-LOW"), statuses=("F", "O"),
    states=tuple(f"NATION_{i}" for i in range(12)), loyalty_tiers=("BUILDING", "MACHINERY"),
)
PRODUCT_SLICE = SliceSpec(
    date_from=dt.date(1996, 3, 1), date_to=dt.date(2000, 9, 30),
    categories=("ECONOMY", "PROMO", "STANDARD"), brands=tuple(f"Brand#{i}" for i in range(1, 15)),
    abc_classes=("A", "B"), segments=("Champions", "Loyal Customers", "At Risk"),
)

MODEL_SLICE = SliceSpec(
    date_from=dt.date(1996, 3, 1), date_to=dt.date(2000, 9, 30),
    categories=("ECONOMY", "PROMO", "STANDARD"), brands=tuple(f"Brand#{i}" for i in range(1, 15)),
)
MODEL_MEASURES = [
    "average_order_value", "revenue_per_customer", "total_orders", "completed_orders", "return_rate", "units_sold",
]

# measure -> grouping it is registered with
GROUPED_MEASURES = {
    "m01": ("total_revenue", ("status", "year")),
    "m02": ("total_cost", ("category",)),
    "m03": ("gross_profit", ("brand",)),
    "m04": ("profit_margin", ("category",)),
    "m05": ("total_discount", ("channel",)),
    "m06": ("average_order_value", ("channel",)),
    "m07": ("revenue_per_customer", ("state",)),
    "m08": ("revenue_per_unit", ("category",)),
    "m09": ("total_orders", ("year",)),
    "m10": ("units_sold", ("loyalty_tier",)),
    "m11": ("completed_orders", ("month",)),
    "m12": ("avg_items_per_order", ("channel",)),
    "m23": ("total_customers", ()),
    "m26": ("avg_customer_lifetime_value", ()),
    "m28": ("total_returns", ("category",)),
    "m29": ("return_rate", ("channel",)),
    "m30": ("total_refund", ("month",)),
}
TIME_MEASURES = {
    "m13": "revenue_prev_month",
    "m14": "mom_change",
    "m15": "mom_growth",
    "m16": "revenue_sply",
    "m17": "yoy_growth",
    "m18": "revenue_ytd",
    "m19": "rolling_3m_revenue",
    "m20": "rolling_12m_revenue",
    "m21": "rolling_3m_margin",
    "m22": "revenue_vs_12m_avg",
    "m35": "target_achievement",
}
SLICED = ["total_revenue", "gross_profit", "units_sold", "total_orders", "average_order_value",
          "revenue_per_customer"]


def grouped(name: str, by: tuple[str, ...]) -> Build:
    return lambda star: M.measures(star, [name], by)


def timed(name: str) -> Build:
    return lambda star: M.time_measure(star, name)


def cumulative(star: DriverStar) -> DataFrame:
    shares = S.cumulative_share(S.product_revenue(star))
    return shares.withColumn("revenue", dollars("revenue")).withColumn("cumulative_share", round_half("cumulative_share", 9))


def abc(star: DriverStar) -> DataFrame:
    return S.product_abc(star).select(
        "product_id", dollars("revenue").alias("revenue"), "abc_class"
    )


def without_some_dates(star: DriverStar) -> DriverStar:
    """The star with the order dates of every 50th customer missing."""
    out = DriverStar(star.spark, star.folder, star.params)
    kept = F.when(F.col("customer_id") % 50 != 0, F.col("order_date"))
    out.__dict__["orders"] = star.orders.withColumn("order_date", kept)
    return out


REPORTS: dict[str, Build] = {
    "a02_customers_by_period": M.customers_by_period,
    "e01_master_fact": lambda s: doubles(E.master_fact(s)),
    "e02_revenue_fact": lambda s: doubles(E.revenue_rows(s)),
    "e03_monthly_trend": E.monthly_trend,
    "e04_annual_revenue": E.annual_revenue,
    "e05_orders_by_weekday": E.weekday_orders,
    "e06_category_margin": E.category_margin,
    "e07_channel_revenue": E.channel_revenue,
    "e07_category_share": E.category_share,
    "e08_top_states": E.top_states,
    "e09_rfm_base": lambda s: S.rfm_base(s).withColumn("monetary", dollars("monetary")),
    "e10_rfm_segments": S.rfm,
    "e10_rfm_segments_parity": lambda s: S.rfm(s, parity=True),
    "e11_cohort_retention": cohort.cohort_retention,
    "e12_retention_curve": lambda s: cohort.retention_curve(cohort.cohort_retention(s)),
    "e13_segment_summary": S.segment_summary,
    "e14_rfm_distributions": S.rfm_distributions,
    "e15_return_rate_by_category": E.return_rate_by_category,
    "e15_return_rate_no_fan_out": lambda s: E.return_rate_by_category(s, fan_out=False),
    "e16_return_reasons": E.return_reasons,
    "e17_monthly_return_rate": E.monthly_return_rate,
    "e18_top20_products": E.top_products,
    "e19_price_boxes": E.price_boxes,
    "e20_headline": E.headline,
    "e21_summary_report": E.summary_report,
    "p01_dashboard_fact": lambda s: doubles(P.dashboard_fact(s)),
    "p02_monthly_change": P.monthly_change,
    "p03_page_kpis": P.page_kpis,
    "p04_trailing_revenue": P.trailing_revenue,
    "p05_daily_trend": P.daily_trend,
    "p06_aov_by_channel": P.aov_by_channel,
    "p07_customer_kpis": P.customer_kpis,
    "p08_segment_revenue": P.segment_revenue,
    "p08_distributions": P.page_distributions,
    "p09_retention_excerpt": cohort.retention_excerpt,
    "p10_new_returning_pivot": P.new_returning_pivot,
    "p11_returns_kpis": P.returns_kpis,
    "p12_top15_products": P.top_products_by_id,
    "p13_margin_vs_average": P.margin_against_average,
    "p13_return_rate_vs_average": P.return_rate_against_average,
    "p14_revenue_by_category": lambda s: P.revenue_by(s, "category"),
    "p14_revenue_by_year": lambda s: P.revenue_by(s, "year"),
    "p14_revenue_by_channel": lambda s: P.revenue_by(s, "channel"),
    "f09_sliced_by_orders": lambda s: M.measures(s, SLICED, ["month"], ORDER_SLICE),
    "f09_sliced_by_products": lambda s: M.measures(s, SLICED, ["channel"], PRODUCT_SLICE),
    "m06_model_filters_by_category": lambda s: M.measures(s, MODEL_MEASURES, ["category"], MODEL_SLICE, model_filters=True),
    "m06_model_filters_by_channel": lambda s: M.measures(s, MODEL_MEASURES, ["channel"], MODEL_SLICE, model_filters=True),
    "e10_parity_with_missing_dates": lambda s: S.rfm(without_some_dates(s), parity=True),
    "w11_cumulative_share": cumulative,
    **{f"{k}_{name}": grouped(name, by) for k, (name, by) in GROUPED_MEASURES.items()},
    **{f"{k}_{name}": timed(name) for k, name in TIME_MEASURES.items()},
    "m24_active_customers": M.active_customers,
    "m24_active_customers_by_day": lambda s: M.active_customers(s, grain="day"),
    "m25_new_customers": M.new_customers,
    "m27_retention_rate": M.retention_rate,
    "m31_abc_class": abc,
    "m32_what_if": M.what_if,
    "m32_what_if_by_month": lambda s: M.what_if(s, by_month=True),
    "m33_category_revenue_share": M.category_revenue_share,
    "m34_segment_revenue_share": M.segment_revenue_share,
    "m36_date_dimension": M.date_dimension,
    "m37_product_detail": lambda s: M.product_detail(s, DETAIL_CATEGORY),
    "m38_state_tooltip": M.state_tooltip,
    "m39_churn_risk": M.churn_risk,
    "m40_product_table": M.product_table,
}
REPORTS = dict(sorted(REPORTS.items()))
