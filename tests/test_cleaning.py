"""Raw CSV files with one of each defect, through the whole cleaning."""

import csv
import datetime as dt

import pytest

from tillwise.plans import cleaning
from tillwise.plans.cleaning import CleaningRules
from tillwise.schema import KNOWN_DATES, RAW_COLUMNS
from tillwise.sources import files

D = dt.date


def customer(id, first="Ann", last="Lee", email=None, phone="5551234567", born="1980-01-02",
             registered="2023-03-15", state=" ca ", country="US", tier="Gold"):
    return [id, first, last, email, phone, "F", born, registered, "X", state, country, " 00123",
            tier, "Web"]


CUSTOMERS = [
    customer(3, "JOHN", "o'neil", "a@x.com"), customer(2, "mary", "anne-marie", "A@X.COM"),
    customer(4, email="joeATexampleDOTcom", tier="Bronz"),
    customer(5, email=None, phone="555-12", tier="Diamond"),
    customer(6, email="b@x.com", registered="03/15/2023", country="U.S.", tier="GOLD"),
    customer(7, email="c@x.com", born=None, phone=None, country=" US ", tier=None),
    customer(8, email="d@x.com"), customer(8, email="d@x.com"),
]


def product(id, price, name="Plain Mug", cost="2.00", category="Home", weight="1.0", stock="5",
            launch="2020-01-01"):
    return [id, f"S{id}", name, category, "Sub", "B", cost, price, "7", "1", launch, weight, stock]


PRODUCTS = [
    product(1, "$12.50", "MEN'S APPAREL PRO", weight="2.0"), product(2, "12.50 USD", weight="4.0"),
    product(3, "abc", weight=None), product(4, "10.00", stock="-7", launch="soon"),
    product(5, "11.00", cost="20.00"), product(6, "1250.00"),
    product(7, "12.00", category="Toys", weight=None), product(2, "12.50 USD", weight="4.0"),
]


def order(id, customer, ordered="2023-03-10", shipped="2023-03-12", delivered="2023-03-15",
          shipping="5.00", country="USA", status="Completed"):
    return [id, customer, ordered, shipped, delivered, "Web", "Card", shipping, "0.00", status,
            "X", "CA", country]


ORDERS = [
    order(1, 2), order(2, 2, shipped="2023-03-07"), order(3, None), order(4, 99, shipped=None),
    order(5, 2, ordered="03-15-2023", shipping="x"), order(6, 8, shipping=None, country="U.S."),
    order(7, 8, shipping="5000"), order(8, 8), order(9, 8), order(10, 8), order(10, 8),
]


def item(id, order, product, quantity="2", price="10.00", discount="0.1000"):
    return [id, order, product, quantity, price, discount, "0"]


ITEMS = [
    item(1, 1, 1), item(2, 1, 2, quantity="-3"), item(3, 2, 2, quantity="0"),
    item(4, 2, 1, price=None), item(5, 2, 3, price=None), item(6, 2, 999),
    item(7, 999, 1), item(8, 3, 1, discount="-0.1"), item(9, 3, 1, discount="1.4"),
    item(10, 3, 1, discount=None), item(10, 3, 1, discount=None),
]


def returned(id, order, product, day="2023-04-01", reason="Broken", refund="10.00"):
    return [id, order, product, day, reason, refund, "Approved"]


RETURNS = [
    returned(1, 1, 1), returned(2, 1, 2, day="15 Mar 2023"), returned(3, 2, 2, reason=None),
    returned(4, 2, 2, refund="50000"), returned(5, 2, 999), returned(6, 999, 1),
    returned(7, 3, 1, refund="12.00"), returned(8, 3, 1, refund="11.00"), returned(8, 3, 1, refund="11.00"),
]
DATA = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "order_items": ITEMS,
        "returns": RETURNS}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for table, rows in DATA.items():
        with open(folder / f"{table}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(RAW_COLUMNS[table])
            out.writerows([["" if v is None else v for v in row] for row in rows])
    return {t: files.read_raw(spark, str(folder), t) for t in DATA}


@pytest.fixture(scope="module")
def clean(raw):
    return {t: df.collect() for t, df in cleaning.clean_all(raw).items()}


def by(rows, key):
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r for r in rows}


def test_customers(clean):
    got = by(clean["customers"], "customer_id")
    # 3 repeats the address of 2; 4 and 5 have none and count as one.
    assert set(got) == {2, 4, 6, 7, 8}
    assert (got[2]["first_name"], got[2]["last_name"]) == ("Mary", "Anne-Marie")
    assert got[4]["email"] is None and got[4]["loyalty_tier"] == "Bronze"
    assert got[6]["registration_date"] is None and got[6]["country"] == "US"
    assert got[7]["country"] == "US" and got[7]["loyalty_tier"] is None
    assert got[2]["state"] == "CA" and got[2]["postal_code"] == "00123"


def test_lenient_rules_keep_more(raw):
    rules = CleaningRules(dates=KNOWN_DATES, loose_email=True, null_email="keep")
    got = {r["customer_id"]: r for r in cleaning.clean_customers(raw["customers"], rules).collect()}
    assert set(got) == {2, 4, 5, 6, 7, 8}
    assert got[4]["email"] == "joe@example.com"
    assert got[6]["registration_date"] == D(2023, 3, 15)


def test_products(clean):
    got = by(clean["products"], "product_id")
    assert len(got) == 7
    assert got[1]["product_name"] == "Men'S Apparel Pro" and float(got[1]["unit_price"]) == 12.5
    assert got[3]["unit_price"] is None and got[3]["weight_kg"] == 1.0
    assert got[4]["stock_quantity"] == 7 and got[4]["launch_date"] is None
    assert got[5]["margin_flag"] == 1 and got[3]["margin_flag"] == 0
    assert float(got[6]["unit_price"]) < 20  # capped
    assert got[7]["weight_kg"] is None  # no other weight in its category


def test_orders(clean):
    got = by(clean["orders"], "order_id")
    assert len(got) == 10
    assert got[2]["ship_date"] is None and got[2]["delivery_date"] is None
    assert got[4]["ship_date"] is None and got[4]["delivery_date"] == D(2023, 3, 15)
    assert got[3]["orphaned_order"] == 1 and got[4]["orphaned_order"] == 0
    assert got[5]["order_date"] is None and got[5]["order_month"] is None
    assert float(got[7]["shipping_cost"]) == 5.0
    assert got[1]["country"] == "US" and got[6]["country"] == "U.S."
    assert (got[1]["order_year"], got[1]["order_month"], got[1]["order_dow"]) == (
        2023, "2023-03", "Friday")


def test_order_items(clean):
    got = by(clean["order_items"], "item_id")
    assert set(got) == {1, 2, 3, 4, 5, 8, 9, 10}
    assert (got[2]["quantity"], got[3]["quantity"]) == (3, 1)
    assert float(got[4]["unit_price"]) == 12.5 and got[5]["unit_price"] is None
    assert got[5]["line_total"] is None
    assert [float(got[i]["line_total"]) for i in (1, 8, 9, 10)] == [18.0, 20.0, 0.0, 20.0]


def test_returns(clean):
    got = by(clean["returns"], "return_id")
    assert set(got) == {1, 2, 3, 4, 7, 8}
    assert got[2]["return_date"] is None and got[3]["reason"] == "Unknown"
    assert float(got[4]["refund_amount"]) < 20


def test_quality_log_counts(raw):
    got = {(r["table_name"], r["rule"]): r["affected"] for r in cleaning.quality_log(raw).collect()}
    assert got["customers", "exact_duplicates"] == 1
    assert got["customers", "email_invalid"] == 2
    assert got["customers", "email_duplicates"] == 2
    assert got["customers", "loyalty_tier_unrecognised"] == 1
    assert got["products", "price_capped"] == 1 and got["products", "price_below_cost"] == 1
    assert got["orders", "shipped_before_ordered"] == 1
    assert got["orders", "order_date_unreadable"] == 1
    assert got["orders", "customer_missing"] == 1
    assert got["order_items", "quantity_negative"] == 1
    assert got["order_items", "price_still_missing"] == 1  # product 3 has no price to lend
    assert got["order_items", "product_orphans"] == 1 and got["order_items", "order_orphans"] == 1
    assert got["returns", "product_orphans"] == 1 and got["returns", "order_orphans"] == 1


def test_rows_are_conserved(raw, clean):
    log = {(r["table_name"], r["rule"]): r["affected"] for r in cleaning.quality_log(raw).collect()}
    removed = sum(log["order_items", k] for k in ("exact_duplicates", "product_orphans", "order_orphans"))
    assert len(clean["order_items"]) + removed == len(ITEMS)


def test_foreign_keys(raw):
    got = {r["child"]: r["orphans"] for r in cleaning.integrity_report(cleaning.clean_all(raw)).collect()}
    assert got == {"orders": 1, "order_items": 0, "returns": 0}


def test_cleaning_orders_twice_changes_nothing(spark, raw):
    once = cleaning.clean_orders(raw["orders"])
    as_text = once.select(*[once[c].cast("string").alias(c) for c in RAW_COLUMNS["orders"]])
    twice = cleaning.clean_orders(as_text)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)


def test_write_and_read_back(spark, raw, tmp_path):
    products = cleaning.clean_products(raw["products"])
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        files.write_table(products, path, fmt)
        back = files.read_clean(spark, path, "products", fmt)
        assert back.count() == products.count()
        assert dict(back.dtypes)["unit_price"] == "decimal(18,2)"
    orders = cleaning.clean_orders(raw["orders"])
    files.write_table(orders, str(tmp_path / "o"), partition_by=["order_year"])
    loaded = files.load_table(
        spark, str(tmp_path / "o"), "orders_loaded", ["order_date"], ["order_month"])
    assert "order_month" not in loaded.columns
    assert spark.sql("SELECT count(*) FROM orders_loaded").collect()[0][0] == 10
    counts = files.row_counts({"a": loaded, "b": products}).collect()
    assert {r["table_name"]: r["row_count"] for r in counts} == {"a": 10, "b": 7}


def test_bucketed_tables_join_without_an_exchange(spark, raw):
    clean = cleaning.clean_all(raw)
    files.write_bucketed(clean["orders"], "bucketed_orders", "order_id", 4)
    files.write_bucketed(clean["order_items"], "bucketed_items", "order_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_items").join(spark.table("bucketed_orders"), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_orders")
        spark.sql("DROP TABLE bucketed_items")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_errors_are_not_swallowed(spark, tmp_path):
    with pytest.raises(Exception):
        files.export_result(spark.sql("SELECT raise_error('broken')"), str(tmp_path / "x"))
