"""Analytic edge cases on a hand-written star, and heavy keys against brute force."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tillwise.operators.affinity import top_pairs
from tillwise.operators.star import SliceSpec, Star
from tillwise.plans import cohort, eda, measures, queries as Q, segments
from tillwise.plans.dashboards import aov_by_channel
from tillwise.schema import CLEAN_SCHEMAS, Params

D = dt.date
COLUMNS = {
    "customers": ["customer_id", "first_name", "last_name", "loyalty_tier", "state"],
    "products": ["product_id", "product_name", "category", "sub_category", "brand", "unit_cost",
                 "unit_price"],
    "orders": ["order_id", "customer_id", "order_date", "channel", "status", "state"],
    "order_items": ["item_id", "order_id", "product_id", "quantity", "unit_price",
                    "discount_pct", "line_total"],
    "returns": ["return_id", "order_id", "product_id", "return_date", "reason", "refund_amount"],
}


def star(spark, params=None, **tables):
    frames = {}
    for name, columns in COLUMNS.items():
        schema = spark.createDataFrame([], CLEAN_SCHEMAS[name]).select(*columns).schema
        rows = [tuple(
            Decimal(str(v)) if f.dataType.typeName() == "decimal" and v is not None else v
            for v, f in zip(row, schema)) for row in tables.get(name, [])]
        frames[name] = spark.createDataFrame(rows, schema)
    return Star(**frames, params=params or Params())


def product(id, name="P", category="C", cost=4, price=10):
    return (id, name, category, "s", "b", cost, price)


def order(id, customer=1, day=D(2024, 1, 1), status="Completed", channel="Web", state="CA"):
    return (id, customer, day, channel, status, state)


def line(order, product=1, total=10, quantity=1, disc=0, item=1):
    return (item, order, product, quantity, 10, disc, total)


def rows(df):
    return [tuple(r) for r in df.collect()]


CUSTOMERS = [(1, "A", "B", "Gold", "CA"), (2, "C", None, None, "NY")]


def test_row_lag_against_calendar_shift(spark):
    s = star(
        spark, products=[product(1)],
        orders=[order(1, day=D(2024, 1, 5)), order(2, day=D(2024, 2, 5)), order(3, day=D(2024, 4, 5))],
        order_items=[line(1, total=100), line(2, total=150), line(3, total=300)],
    )
    assert [r[2] for r in rows(Q.q02(s))] == [None, 100.0, 150.0]
    series = {r["month"]: r for r in measures.monthly_series(s).collect()}
    assert list(series) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert series["2024-04"]["revenue_prev_month"] is None
    assert series["2024-04"]["mom_change"] == 300.0 and series["2024-04"]["mom_growth"] is None
    assert series["2024-03"]["rolling_3m_revenue"] == 250.0


def test_rolling_window_is_thirty_calendar_days(spark):
    days = [D(2024, 1, 1), D(2024, 1, 30), D(2024, 1, 31), D(2024, 4, 1)]
    s = star(
        spark, products=[product(1)],
        orders=[order(i, day=d) for i, d in enumerate(days)],
        order_items=[line(i, total=10 * (i + 1)) for i in range(4)],
    )
    assert [r[2] for r in rows(Q.q05(s))] == [10.0, 30.0, 50.0, 40.0]
    # 90 days up to 1 April reach back to 3 January
    assert [r[3] for r in rows(Q.q06(s))] == [1, 2, 3, 3]


def test_ties_share_a_rank_and_names_merge(spark):
    products = [product(i, name) for i, name in enumerate("abcdefg")] + [product(9, "a")]
    totals = [90, 80, 70, 60, 50, 50, 40]
    s = star(
        spark, products=products, orders=[order(1)],
        order_items=[line(1, i, t) for i, t in enumerate(totals)] + [line(1, 9, 5)],
    )
    got = rows(Q.q08(s))
    assert len(got) == 6 and [r[6] for r in got] == [1, 2, 3, 4, 5, 5]
    assert got[0][1:4] == ("a", "b", 95.0) and got[0][5] == 1


def test_churn_limits_and_undated_customers(spark):
    as_of = D(2024, 12, 31)
    gaps = [90, 91, 180, 181, None]
    s = star(
        spark, customers=[(i, "A", "B", "Gold", "CA") for i in range(5)],
        orders=[order(i, i, None if g is None else as_of - dt.timedelta(g)) for i, g in enumerate(gaps)],
    )
    got = {r["customer_id"]: r["churn_status"] for r in Q.q10(s).collect()}
    assert got == {0: "Active", 1: "At Risk", 2: "At Risk", 3: "Churned", 4: "Active"}


def test_first_day_orders_are_all_new_and_cancelled_orders_set_the_first_day(spark):
    s = star(
        spark, products=[product(1)],
        orders=[order(1, 1, D(2024, 1, 1)), order(2, 1, D(2024, 1, 1)), order(3, 1, D(2024, 1, 2)),
                order(4, 2, D(2024, 1, 1), "Cancelled"), order(5, 2, D(2024, 2, 1))],
        order_items=[line(i) for i in range(1, 6)],
    )
    assert rows(Q.q11(s)) == [
        ("2024-01", "New", 2, 1, 20.0), ("2024-01", "Returning", 1, 1, 10.0),
        ("2024-02", "Returning", 1, 1, 10.0)]
    assert {r[:3] for r in rows(Q.q18(s))} == {
        ("2024-01", "2024-01", 0), ("2024-01", "2024-02", 1)}
    matrix = cohort.cohort_retention(s, min_size=1).collect()
    assert [(r["cohort_month"], r["0"], r["1"]) for r in matrix] == [
        ("2024-01", 100.0, 0.0), ("2024-02", 100.0, 0.0)]


def test_cohorts_under_the_size_limit_are_left_out(spark):
    orders = [order(i, i, D(2024, 1, 1)) for i in range(20)]
    orders += [order(100 + i, 100 + i, D(2024, 2, 1)) for i in range(19)]
    s = star(spark, products=[product(1)], orders=orders, order_items=[line(o[0]) for o in orders])
    assert [r["cohort_month"] for r in cohort.cohort_retention(s).collect()] == ["2024-01"]


def test_discount_bounds(spark):
    discounts = ["0", "0.10", "0.20", "0.30", None]
    s = star(
        spark, products=[product(1)], orders=[order(1)],
        order_items=[line(1, disc=d, item=i) for i, d in enumerate(discounts)],
    )
    got = {r[0]: r[1] for r in rows(Q.q17(s))}
    assert got == {"0% (no discount)": 1, "1-10%": 1, "11-20%": 1, "21-30%": 1, "31%+": 1}


def test_order_count_bounds(spark):
    orders, n = [], 0
    for customer, count in enumerate([1, 3, 6, 10, 11]):
        for _ in range(count):
            orders.append(order(n, customer))
            n += 1
    got = rows(Q.q15(star(spark, orders=orders)))
    assert [(r[0], r[1], r[2]) for r in got] == [
        ("1 order (one-time)", 1, 1.0), ("2-3 orders", 1, 3.0), ("4-6 orders", 1, 6.0),
        ("7-10 orders", 1, 10.0), ("10+ orders (loyal)", 1, 11.0)]
    assert sum(r[3] for r in got) == pytest.approx(100)


def test_returns_fan_out_over_repeated_lines(spark):
    s = star(
        spark, products=[product(1)], orders=[order(1), order(2)],
        order_items=[line(1), line(1, item=2), line(2)],
        returns=[(1, 1, 1, D(2024, 2, 1), "x", 5), (2, 7, 1, D(2024, 2, 1), "x", 5)],
    )
    assert rows(eda.return_rate_by_category(s))[0][1:] == (3, 2, 150.0)
    assert rows(eda.return_rate_by_category(s, fan_out=False))[0][1:] == (2, 2, 100.0)


def test_missing_weekday_is_null(spark):
    s = star(spark, orders=[order(1, day=D(2024, 1, 1)), order(2, day=D(2024, 1, 7))])
    assert rows(eda.weekday_orders(s)) == [
        ("Monday", 1), ("Tuesday", None), ("Wednesday", None), ("Thursday", None),
        ("Friday", None), ("Saturday", None), ("Sunday", 1)]


def test_unknown_customers_count_in_orders_but_not_as_customers(spark):
    s = star(
        spark, customers=CUSTOMERS, products=[product(1)],
        orders=[order(1), order(2, None), order(3, 99)], order_items=[line(1), line(2), line(3)],
    )
    assert rows(Q.q12(s))[0][:4] == ("Web", 3, 2, 30.0)
    assert [r[0] for r in rows(Q.q09(s))] == [1]
    assert rows(Q.q22(s))[0][:3] == ("CA", 3, 2)


def test_lines_without_cost_or_total(spark):
    s = star(
        spark, products=[product(1), product(2, cost=None)], orders=[order(1)],
        order_items=[line(1, 1, 10), line(1, 2, 10), line(1, 1, None)],
    )
    # Profit skips the line without a cost, the mean skips the line without a total.
    assert rows(Q.q01(s)) == [("2024", "Completed", 1, 20.0, 6.0, 10.0, 20.0)]


def test_abc_of_ties_unsold_products_and_one_dominant_product(spark):
    def classes(totals):
        s = star(
            spark, products=[product(i) for i in range(len(totals) + 1)], orders=[order(1)],
            order_items=[line(1, i, t) for i, t in enumerate(totals)],
        )
        return [r["abc_class"] for r in segments.product_abc(s).orderBy("product_id").collect()]

    assert classes([40, 40, 10, 5, 5]) == ["A", "A", "B", "C", "C", "C"]
    assert classes([90, 10]) == ["B", "C", "C"]


def test_parity_scores_are_constant_with_an_undated_customer(spark):
    orders = [order(i, i, D(2024, 1, 1) + dt.timedelta(7 * i)) for i in range(20)] + [order(99, 99, None)]
    items = [line(o[0], total=10 + o[0]) for o in orders]
    s = star(spark, products=[product(1)], orders=orders, order_items=items)
    parity = segments.rfm(s, parity=True).collect()
    assert {r["R_score"] for r in parity} == {3} and {r["F_score"] for r in parity} == {3}
    assert {r["M_score"] for r in parity} == {1, 2, 3, 4, 5}
    assert [r["R_score"] for r in segments.rfm(s).collect() if r["customer_id"] == 99] == [1]


def test_active_customers_equal_a_range_join(spark):
    rng = np.random.default_rng(5)
    n = 300
    days = [D(2024, 1, 1) + dt.timedelta(int(x)) for x in rng.integers(0, 200, n)]
    customers = rng.integers(0, 40, n).tolist()
    s = star(spark, orders=[order(i, c, d) for i, (c, d) in enumerate(zip(customers, days))])
    last = max(days)
    for r in measures.active_customers(s).collect():
        end = min((pd.Period(r["month"]).end_time).date(), last)
        seen = {c for c, d in zip(customers, days) if 0 <= (end - d).days < 90}
        assert r["active_customers"] == len(seen)


def test_unset_slicers_set_no_condition(spark):
    s = star(spark, customers=CUSTOMERS, products=[product(1)], orders=[order(1), order(2)],
             order_items=[line(1)])
    plain = rows(measures.measures(s, ["total_revenue", "total_orders"], ["channel"]))
    assert plain == rows(measures.measures(
        s, ["total_revenue", "total_orders"], ["channel"], SliceSpec()))
    assert plain == [("Web", 10.0, 2)]


def heavy(spark, n=3000, seed=2):
    """A third of all lines on one order, on one product and on one customer each."""
    rng = np.random.default_rng(seed)
    orders = [order(i, int(c), D(2024, 1, 1) + dt.timedelta(int(d)), channel=str(i % 3))
              for i, (c, d) in enumerate(zip(rng.integers(0, 60, 400), rng.integers(0, 330, 400)))]
    orders += [order(1000 + i, 7, D(2024, 6, 1)) for i in range(200)]
    o = rng.integers(0, 400, n)
    p = rng.integers(0, 80, n)
    o[: n // 3] = 5
    p[n // 3: 2 * n // 3] = 3
    items = [line(int(a), int(b), int(t), item=i)
             for i, (a, b, t) in enumerate(zip(o, p, rng.integers(1, 500, n)))]
    products = [product(i, f"n{i % 30}", f"c{i % 4}") for i in range(80)]
    customers = [(i, "A", str(i), "Gold", "CA") for i in range(60)]
    return star(spark, customers=customers, products=products, orders=orders, order_items=items)


def brute_pairs(s, n):
    items = s.order_items.select("order_id", "product_id").toPandas()
    products = s.products.select("product_id", "product_name", "category").toPandas()
    names = products.groupby(["product_name", "category"], as_index=False).product_id.min()
    names = names.rename(columns={"product_id": "low"})
    x = items.merge(products.merge(names), on="product_id")
    pairs = x.merge(x, on="order_id")
    pairs = pairs[pairs.product_id_x < pairs.product_id_y]
    top = pairs.groupby(["low_x", "low_y", "product_name_x", "product_name_y"]).size().reset_index(name="t")
    top = top.sort_values(["t", "low_x", "low_y"], ascending=[False, True, True]).head(n)
    return list(zip(top.product_name_x, top.product_name_y, top.t))


@pytest.mark.parametrize("chunk", [1000, 20, 4])
def test_pairs_of_a_heavy_order_equal_brute_force(spark, chunk):
    s = heavy(spark)
    got = [(r[0], r[1], r[4]) for r in rows(top_pairs(s, 12, chunk=chunk))]
    assert got == brute_pairs(s, 12)


def test_pairs_of_an_order_with_3000_products(spark):
    items = [line(1, p, 10, item=p) for p in range(3000)] + [line(2, p, 10, item=p) for p in (7, 9, 11)]
    s = star(spark, customers=[(1, "A", "B", "Gold", "CA")], products=[product(p, f"n{p}", "c") for p in range(3000)],
             orders=[order(1, 1, D(2024, 1, 1)), order(2, 1, D(2024, 1, 2))], order_items=items)
    got = [(r[0], r[1], r[4]) for r in rows(top_pairs(s, 5))]
    assert got == [("n7", "n9", 2), ("n7", "n11", 2), ("n9", "n11", 2), ("n0", "n1", 1), ("n0", "n2", 1)]


def test_order_value_holds_every_year(spark):
    items = [line(k, 1, 10, item=k) for k in (1, 2, 3)]
    days = [D(1987, 5, 1), D(2024, 1, 1), D(2031, 1, 1)]
    orders = [order(k + 1, 1, day) for k, day in enumerate(days)]
    s = star(spark, customers=[(1, "A", "B", "Gold", "CA")], products=[product(1, "n", "c")], orders=orders, order_items=items)
    found = aov_by_channel(s).collect()
    assert [r["year"] for r in found] == [1987, 2024, 2031] and all(r["aov"] > 0 for r in found)


def test_heavy_keys_keep_results_whole(spark):
    s = heavy(spark)
    items, orders = s.order_items.toPandas(), s.orders.toPandas()
    flat = items.merge(orders, on="order_id")
    flat["line_total"] = flat.line_total.astype(float)
    want = flat.groupby("channel").agg(o=("order_id", "nunique"), c=("customer_id", "nunique"),
                                       r=("line_total", "sum"))
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = {r["channel"]: r for r in Q.q12(s).collect()}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for channel, row in want.iterrows():
            assert got[channel]["total_orders"] == row.o
            assert got[channel]["unique_customers"] == row.c
            assert got[channel]["total_revenue"] == pytest.approx(row.r)


def test_shares_and_running_totals_close(spark):
    s = heavy(spark)
    total = sum(r["total_revenue"] for r in Q.q12(s).collect())
    last = Q.q04(s).orderBy(F.desc("month")).first()
    assert last["cumulative_revenue"] == pytest.approx(total)
    shares = measures.category_revenue_share(s).collect()
    assert sum(r["revenue_share"] for r in shares) == pytest.approx(1, abs=1e-5)
