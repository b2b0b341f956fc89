"""Times the headline queries; prints one JSON line.

Each query runs once unmeasured (plan and JIT warm-up), then is measured over BENCH_RUNS
runs (default 3), of which the best counts. The whole result goes to the no-op sink, so
nothing is pruned away.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tillwise.catalog.registry import all_queries  # noqa: E402

HEADLINE = [
    "q01_revenue_summary_by_year", "q02_monthly_revenue_mom", "q03_yoy_revenue_by_category",
    "q04_cumulative_revenue", "q05_rolling_30d_revenue", "q06_rolling_90d_revenue",
    "q07_category_rank", "q08_top5_products_per_category", "q09_customer_lifetime_value",
    "q10_churn_flags", "q11_new_vs_returning_revenue", "q12_channel_performance",
    "q13_aov_by_channel_year", "q14_return_rate_by_category_reason", "q15_order_frequency",
    "q16_top20_customers", "q17_discount_impact", "q18_cohort_revenue",
    "q19_revenue_by_weekday", "q20_product_affinity", "q21_revenue_by_loyalty_tier",
    "q22_geographic_revenue_by_state",
    "e10_rfm_segments", "e11_cohort_retention", "e15_return_rate_by_category",
    "d01_audit", "d29_quality_report", "d30_clean_order_items",
    "m24_active_customers", "m31_abc_class", "m21_rolling_3m_margin",
    "d30_integrity", "e14_rfm_distributions", "e20_headline", "e21_summary_report",
    "f09_sliced_by_products", "m37_product_detail",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tillwise-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for run in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run > 0:
                best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 4)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
