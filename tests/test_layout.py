"""Stored orders and lines: joins without an exchange, months that are not read."""

import datetime as dt
import re

import pytest

from tillwise.catalog.cleaning_queries import CLEANING
from tillwise.catalog.driver import DriverStar
from tillwise.operators.star import SliceSpec, order_revenue
from tillwise.plans import measures, queries
from tillwise.sources import layout
from tillwise.sources.layout import store_star

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return store_star(DriverStar(spark, FOLDER), spark, f"file://{tmp_path_factory.mktemp('layout')}", buckets=4)


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_their_orders_without_an_exchange(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = initial_plan(order_revenue(stored, "channel"))
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert "Exchange" in initial_plan(order_revenue(DriverStar(spark, FOLDER), "channel"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("spec", [
    SliceSpec(date_from=dt.date(1997, 2, 10), date_to=dt.date(1997, 4, 5)), SliceSpec(years=(1996, 1999)), SliceSpec(date_to=dt.date(1996, 1, 31)),
])
def test_other_months_are_not_read(spark, stored, spec):
    plain = DriverStar(spark, FOLDER)
    df = measures.measures(stored, ["total_revenue", "total_orders"], ["channel"], spec)
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", initial_plan(df))
    assert any("order_month" in f for f in filters)
    want = measures.measures(plain, ["total_revenue", "total_orders"], ["channel"], spec)
    assert sorted(df.collect()) == sorted(want.collect())
    read = {f.split("order_month=")[1][:7] for f in measures.apply_slice(stored.orders, spec).inputFiles()}
    assert read == {r["m"] for r in measures.apply_slice(plain.orders, spec).selectExpr("date_format(order_date, 'yyyy-MM') AS m").distinct().collect()}


def test_orders_without_a_date_stay(spark, tmp_path):
    star = DriverStar(spark, FOLDER)
    star.__dict__["orders"] = star.orders.selectExpr(
        "order_id", "customer_id", "IF(order_id % 10 = 0, NULL, order_date) AS order_date", "channel", "status")
    kept = store_star(star, spark, f"file://{tmp_path}", buckets=3)
    assert sorted(kept.orders.drop("order_month").collect(), key=repr) == sorted(star.orders.collect(), key=repr)
    assert kept.lines.count() == star.lines.count()


def own_star(spark, orders, lines):
    """Orders of own rows, some without a date, and their lines, some without an order."""
    star = DriverStar(spark, FOLDER)
    star.__dict__["orders"] = spark.range(orders).selectExpr(
        "id AS order_id", "id % 7 AS customer_id", "IF(id % 10 = 0, NULL, date_add(DATE'1997-01-30', CAST(id % 5 AS INT))) AS order_date",
        "concat('c', id % 3) AS channel", "IF(id % 4 = 0, 'P', 'F') AS status")
    star.__dict__["lines"] = spark.range(lines).selectExpr(
        "id AS item_id", f"IF(id % 50 = 0, NULL, id % {orders}) AS order_id", "id % 20 + 1 AS product_id", "CAST(id % 3 AS INT) AS quantity",
        "CAST(0.05 AS DECIMAL(5,4)) AS discount_pct", "id % 1000 AS amount", "id % 100 AS price")
    return star


@pytest.mark.parametrize("name, build", [("s02_q19_on_stored_layout", queries.q19), ("s02_q12_on_stored_layout", queries.q12)])
def test_larger_tables_get_more_buckets(spark, monkeypatch, name, build):
    """One task has one bucket: with four of them for any table, its rows grow with the table."""
    monkeypatch.setattr(layout, "BUCKET_ROWS", 500, raising=False)
    for orders, lines, buckets in ((300, 1500, 4), (2400, 12000, 24), (6000, 3000, 12)):
        plain = own_star(spark, orders, lines)
        kept = CLEANING[name](plain)
        written = {re.search(r"_(\d{5})\.c", f)[1] for f in kept.inputFiles() if "star_" in f}
        assert len(written) == buckets
        assert kept.collect() == build(plain).collect() != []
