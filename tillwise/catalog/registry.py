"""Every registered query: key -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.catalog.cleaning_queries import CLEANING
from tillwise.catalog.driver import DriverStar
from tillwise.catalog.oracle import named_queries
from tillwise.catalog.oracle_cleaning import cleaning_oracles
from tillwise.catalog.oracle_reports import report_oracles
from tillwise.catalog.report_queries import REPORTS
from tillwise.operators.star import Star
from tillwise.plans import queries as Q

Query = Callable[[SparkSession, str], DataFrame]


def on_star(build: Callable[[DriverStar], DataFrame]) -> Query:
    return lambda spark, folder: build(DriverStar(spark, folder))


NAMED = {
    "q01_revenue_summary_by_year": Q.q01,
    "q02_monthly_revenue_mom": Q.q02,
    "q03_yoy_revenue_by_category": Q.q03,
    "q04_cumulative_revenue": Q.q04,
    "q05_rolling_30d_revenue": Q.q05,
    "q06_rolling_90d_revenue": Q.q06,
    "q07_category_rank": Q.q07,
    "q08_top5_products_per_category": Q.q08,
    "q09_customer_lifetime_value": Q.q09,
    "q10_churn_flags": Q.q10,
    "q11_new_vs_returning_revenue": Q.q11,
    "q12_channel_performance": Q.q12,
    "q13_aov_by_channel_year": Q.q13,
    "q14_return_rate_by_category_reason": Q.q14,
    "q15_order_frequency": Q.q15,
    "q16_top20_customers": Q.q16,
    "q17_discount_impact": Q.q17,
    "q18_cohort_revenue": Q.q18,
    "q19_revenue_by_weekday": Q.q19,
    "q20_product_affinity": Q.q20,
    "q21_revenue_by_loyalty_tier": Q.q21,
    "q22_geographic_revenue_by_state": Q.q22,
}


def run_query(star: Star, name: str) -> DataFrame:
    """A named query over any star of clean tables; an unknown name or a failing plan raises."""
    found = [build for key, build in NAMED.items() if name in (key, key.split("_")[0])]
    if len(found) != 1:
        raise KeyError(f"no query named {name!r}")
    return found[0](star)


def all_queries() -> dict[str, Query]:
    return {key: on_star(build) for key, build in (NAMED | REPORTS | CLEANING).items()}


def all_oracles() -> dict[str, str]:
    return named_queries() | report_oracles() | cleaning_oracles()
