"""What plans read and group by, and that building one starts no job."""

import re

import pytest

from tillwise.catalog.driver import DriverStar
from tillwise.catalog.registry import NAMED, all_queries, run_query
from tillwise.sources.files import append_table, load_table, read_clean

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


WITHOUT_PRODUCTS = [
    "m01_total_revenue", "m05_total_discount", "m06_average_order_value", "m10_units_sold",
    "m13_revenue_prev_month", "m14_mom_change", "m15_mom_growth", "m16_revenue_sply", "m17_yoy_growth",
    "m18_revenue_ytd", "m19_rolling_3m_revenue", "m20_rolling_12m_revenue", "m32_what_if",
]


@pytest.mark.parametrize("name", WITHOUT_PRODUCTS)
def test_measures_read_no_products(spark, name):
    assert "p_partkey" not in plan_of(all_queries()[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["m01_total_revenue", "m02_total_cost", "m04_profit_margin", "m09_total_orders", "m13_revenue_prev_month"])
def test_customers_form_groups_only_where_they_are_counted(spark, name):
    groups = re.findall(r"Aggregate \[([^\]]*)\]", plan_of(all_queries()[name](spark, FOLDER)))
    assert groups and not any("customer_id" in g or "o_custkey" in g for g in groups)
    counted = plan_of(all_queries()["m07_revenue_per_customer"](spark, FOLDER))
    assert re.search(r"Aggregate \[[^\]]*custom", counted) or "o_custkey" in counted


@pytest.mark.parametrize("name", ["d28_dense_id", "d29_quality_report", "d30_clean_order_items", "d30_integrity", "q20_product_affinity", "e14_rfm_distributions"])
def test_building_a_query_starts_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", "building only")
    try:
        all_queries()[name](spark, FOLDER)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup(f"build-{name}")) == []


def test_named_run(spark):
    star = DriverStar(spark, FOLDER)
    assert run_query(star, "q12").collect() == NAMED["q12_channel_performance"](star).collect()
    assert run_query(star, "q19_revenue_by_weekday").columns[0] == "day_of_week"
    with pytest.raises(KeyError):
        run_query(star, "q99")


def test_append_load(spark, tmp_path):
    path = str(tmp_path / "returns")
    for n in (2, 3):
        rows = spark.range(n).selectExpr(
            "id AS return_id", "id AS order_id", "id AS product_id", "DATE'2024-01-02' AS return_date", "'late' AS reason",
            "CAST(1.5 AS DOUBLE) AS refund_amount", "'Approved' AS status", "1 AS helper",
        )
        append_table(rows, path, "returns", drop_cols=["helper"])
    assert read_clean(spark, path, "returns").count() == 5
    loaded = load_table(spark, path, "returns_loaded", date_cols=["return_date"])
    assert loaded.columns == ["return_id", "order_id", "product_id", "return_date", "reason", "refund_amount", "status"]
    assert spark.sql("SELECT sum(refund_amount) AS s FROM returns_loaded").first()["s"] == 7.5
