"""Filters along one-way relationships, and appends that keep keys."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_edges import CUSTOMERS, line, order, product, rows, star

from tillwise.operators.star import SliceSpec, reached_from
from tillwise.plans import eda, measures
from tillwise.schema import CLEAN_SCHEMAS
from tillwise.sources.files import append_keyed, read_clean, write_table


def test_a_filter_goes_from_the_one_side_to_the_many_side():
    assert reached_from("products") == {"products", "order_items", "returns"}
    assert reached_from("customers") == {"customers", "orders", "order_items", "returns", "segments"}
    assert reached_from("dates") == {"dates", "orders", "order_items", "returns"}
    assert reached_from("order_items") == {"order_items"}


def shop(spark):
    return star(
        spark, customers=CUSTOMERS, products=[product(1, category="X"), product(2, category="Y")],
        orders=[order(1), order(2, 2, channel="Store"), order(3, None), order(4, None, status="Cancelled"), order(5, 2)],
        order_items=[line(1, 1, total=10), line(1, 2, total=20), line(2, 2, total=40), line(3, 1, total=30)],
    )


def test_product_filters_do_not_reach_orders(spark):
    s, only_x = shop(spark), SliceSpec(categories=("X",))
    names = ["total_revenue", "total_orders", "completed_orders", "average_order_value", "revenue_per_customer"]
    # 5 orders, 4 of them completed; customers 1, 2 and the blank one.
    assert rows(measures.measures(s, names, [], only_x, model_filters=True)) == [(40.0, 5, 4, 8.0, round(40 / 3, 2))]
    assert rows(measures.measures(s, names, [], only_x)) == [(40.0, 2, 2, 20.0, 40.0)]
    by_category = {r[0]: r[1:] for r in rows(measures.measures(s, names, ["category"], model_filters=True))}
    assert by_category == {"X": (40.0, 5, 4, 8.0, 13.33), "Y": (60.0, 5, 4, 12.0, 20.0)}


def test_order_filters_reach_lines(spark):
    s, names = shop(spark), ["total_revenue", "total_orders", "revenue_per_customer"]
    by_channel = {r[0]: r[1:] for r in rows(measures.measures(s, names, ["channel"], model_filters=True))}
    assert by_channel == {"Web": (60.0, 4, 20.0), "Store": (40.0, 1, 40.0)}
    both = {r[:2]: r[2:] for r in rows(measures.measures(s, names, ["channel", "category"], SliceSpec(channels=("Web",)), model_filters=True))}
    assert both == {("Web", "X"): (40.0, 4, 13.33), ("Web", "Y"): (20.0, 4, 6.67)}


def test_lattice_holds_the_sums_of_each_grain(spark):
    """A line of an unknown product, one without an order, and an order without a date or channel."""
    s = star(
        spark, products=[product(1, category="X"), product(2, category="Y"), product(3, category=None)],
        orders=[order(1), order(2, channel="Store", day=dt.date(2023, 5, 1)), order(3, channel=None, day=None), order(4, status="Cancelled")],
        order_items=[line(1, 1, 10), line(1, 2, 20), line(2, 1, 40), line(2, 9, 5), line(3, 2, 7), line(4, 1, 99), line(8, 1, 99), line(1, 3, 3)],
    )
    got = {}
    for r in eda.sum_lattice(s).collect():
        got.setdefault(r["grain"], {})[r[r["grain"]] if r["grain"] != "total" else None] = (r["revenue"] / 100, r["profit"] and r["profit"] / 100)
    assert got["total"] == {None: (85.0, 85 - 5 - 5 * 4)}
    assert got["category"] == {"X": (50.0, 42.0), "Y": (27.0, 19.0), None: (8.0, -1.0)}
    assert {k: v[0] for k, v in got["channel"].items()} == {"Web": 33.0, "Store": 45.0, None: 7.0}
    assert {k: v[0] for k, v in got["year"].items()} == {2024: 33.0, 2023: 45.0, None: 7.0}


RETURNS = "return_id BIGINT, order_id BIGINT, product_id BIGINT, return_date DATE, reason STRING, refund_amount DECIMAL(18,2), status STRING, helper INT"


def returned(spark, *ids):
    day = dt.date(2024, 1, 2)
    return spark.createDataFrame([(*i, day, "late", Decimal("1.50"), "Approved", 1) for i in ids], RETURNS)


def parent(spark, tmp_path, table, key, values):
    path = str(tmp_path / table)
    keys = spark.createDataFrame([(v,) for v in values], f"{key} BIGINT")
    fields = spark.createDataFrame([], CLEAN_SCHEMAS[table]).schema
    write_table(keys.select(*[F.col(f.name) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]), path)
    return path


def test_keyed_append(spark, tmp_path):
    parents = {"orders": parent(spark, tmp_path, "orders", "order_id", [1, 2]), "products": parent(spark, tmp_path, "products", "product_id", [5])}
    path = str(tmp_path / "returns")
    batch = returned(spark, (1, 1, 5), (2, 2, 5), (2, 2, 5), (3, 9, 5), (4, 1, 6), (None, 1, 5), (6, None, 5), (2, 1, 5))
    for _ in range(2):  # the second run changes nothing
        rejects = {(r["return_id"], r["order_id"]): r["verdict"] for r in append_keyed(spark, batch, path, "returns", parents).collect()}
        assert sorted((r["return_id"], r["order_id"]) for r in read_clean(spark, path, "returns").collect() if r["order_id"]) == [(1, 1), (2, 1)]
        assert read_clean(spark, path, "returns").count() == 3
        assert {k: v for k, v in rejects.items() if k != (2, 2)} == {(3, 9): "no parent: order_id", (4, 1): "no parent: product_id", (None, 1): "no key"}
        assert rejects[2, 2] in ("key repeated", "key taken")
    changed = append_keyed(spark, returned(spark, (1, 2, 5), (7, 2, 5)), path, "returns", parents).collect()
    assert [(r["return_id"], r["verdict"]) for r in changed] == [(1, "key taken")]
    assert sorted(r["return_id"] for r in read_clean(spark, path, "returns").collect()) == [1, 2, 6, 7]


def test_keyed_append_passes_other_errors_on(spark, tmp_path):
    with pytest.raises(KeyError):
        append_keyed(spark, returned(spark, (1, 1, 5)), str(tmp_path / "returns"), "returns", {})
