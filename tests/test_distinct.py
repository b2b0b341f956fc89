"""Bitmaps that add up, the sweep of active customers, month masks, pairs under bounds."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_edges import line, order, product, star

from tillwise.catalog.registry import all_queries
from tillwise.operators import affinity
from tillwise.operators.distinct import cell_counts, dense_numbers, distinct_rollup, merge_cells
from tillwise.plans import cohort, measures

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("dense", [False, True])
def test_rollups_merge_to_distinct_counts(spark, dense):
    rng = np.random.default_rng(4)
    n = 30_000
    ids = rng.integers(0, 70_000, n)  # more than two bitmaps hold
    pdf = pd.DataFrame({"a": rng.integers(0, 3, n), "b": rng.integers(0, 4, n), "id": ids if dense else ids * 7_000_000_019 - (1 << 40)})
    df = spark.createDataFrame(pdf).unionAll(spark.sql("SELECT 0L, 0L, CAST(NULL AS BIGINT)"))
    cells = distinct_rollup(df, ["a", "b"], "id", dense)
    assert max(r[0] for r in cells.select(F.length("bits")).collect()) == 4096
    for dims in (["a", "b"], ["a"], ["b"]):
        got = {tuple(r)[:-1]: r["n"] for r in cell_counts(merge_cells(cells, dims), dims, "n").collect()}
        want = pdf.groupby(dims).id.nunique()
        assert got == {(k if isinstance(k, tuple) else (k,)): v for k, v in want.items()}
    assert cell_counts(cells.where("a < 0"), ["a"]).collect() == []


def test_dense_numbers_of_text_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "id STRING")
    assert sorted(map(tuple, dense_numbers(df, "id").collect())) == [("a", 1), ("b", 2), ("c", 3)]


def test_period_counts_without_distinct_counts(spark):
    plan = plan_of(all_queries()["a02_customers_by_period"](spark, FOLDER))
    assert "Expand" not in plan and "count(distinct" not in plan and "bitmap_or_agg" in plan


def test_active_customers_by_day_equal_a_range_join(spark):
    rng = np.random.default_rng(6)
    n = 400
    days = [dt.date(2024, 1, 1) + dt.timedelta(int(x)) for x in rng.integers(0, 400, n)]
    days[:4] = [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 3, 31), dt.date(2024, 6, 29)]  # 90 days apart, and one day twice
    customers = rng.integers(0, 60, n).tolist()
    customers[:4] = [99] * 4
    s = star(spark, orders=[order(i, c, d) for i, (c, d) in enumerate(zip(customers, days, strict=True))])
    df = measures.active_customers(s, grain="day")
    got = {r["date"]: r["active_customers"] for r in df.collect()}
    assert min(got) == min(days) and max(got) == max(days) and len(got) == (max(days) - min(days)).days + 1
    for day, n_active in got.items():
        assert n_active == len({c for c, d in zip(customers, days, strict=True) if 0 <= (day - d).days < 90})
    with pytest.raises(ValueError):
        measures.active_customers(s, grain="week")


@pytest.mark.parametrize("name", ["m24_active_customers", "m24_active_customers_by_day"])
def test_sweeps_group_by_day_only(spark, name):
    plan = plan_of(all_queries()[name](spark, FOLDER))
    assert "Distinct" not in plan and "interval" not in plan.lower().replace("specifiedwindowframe", "")
    assert "Aggregate [customer_id" not in plan


def test_month_masks_over_many_years(spark):
    """Months that share a bit number in different words, and one that is 12 months after the first."""
    dates = {1: ["1999-12-31", "2000-01-01", "2000-12-01", "2005-04-01", "2010-08-15"], 2: ["2005-04-02", "2005-05-02", "2006-05-02"], 3: ["1999-12-05"]}
    orders = [order(10 * c + k, c, dt.date.fromisoformat(d)) for c, ds in dates.items() for k, d in enumerate(ds)] + [order(99, 4, None)]
    s = star(spark, products=[product(1)], orders=orders, order_items=[line(o[0]) for o in orders])
    got = {str(r["cohort"]): tuple(r)[1:] for r in cohort.cohort_counts(s, 13).collect()}
    assert got == {
        "1999-12-01": (2, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0), "2005-04-01": (1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1),
    }
    late = star(spark, products=[product(1)], orders=[order(1, 1, dt.date(1950, 1, 1)), order(2, 1, dt.date(2000, 1, 1))],
                order_items=[line(1), line(2)])
    with pytest.raises(Exception, match="longer than 512 months"):
        cohort.cohort_counts(late, 3).collect()


def test_cohorts_take_two_aggregations(spark):
    plan = plan_of(all_queries()["e11_cohort_retention"](spark, FOLDER))
    assert "Window" not in plan and "bit_or" in plan
    assert plan.count("Aggregate [customer_id") == 1 and plan.count("Aggregate [first") == 1


def pair_star(spark):
    """A few names are in most orders; a long tail is in one or two."""
    rng = np.random.default_rng(8)
    products = [product(i, name=f"p{i}") for i in range(1, 401)]
    orders, items = [order(i) for i in range(150)], []
    for i in range(150):
        strong = rng.choice(np.arange(1, 9), 4, replace=False)
        weak = rng.choice(np.arange(9, 401), 8, replace=False)
        items += [line(i, int(p), item=10 * i + k) for k, p in enumerate([*strong, *weak])]
    return star(spark, products=products, orders=orders, order_items=items)


def test_bounds_leave_most_pairs_unformed(spark):
    s = pair_star(spark)
    lines, _ = affinity._folded_lines(s)
    every = affinity._by_chunks(lines, 1000).agg(F.sum("times")).first()[0]
    kept = affinity.candidate_lines(lines, 10, 1000, seeds=8)
    formed = affinity._by_chunks(kept, 1000).agg(F.sum("times")).first()[0]
    assert formed < 0.2 * every
    exact = affinity._by_chunks(lines, 1000).orderBy(F.desc("times"), "a", "b").limit(10).collect()
    for seeds in (2, 8, 256):
        got = affinity._by_chunks(affinity.candidate_lines(lines, 10, 1000, seeds), 1000).orderBy(F.desc("times"), "a", "b").limit(10).collect()
        assert got == exact
    bounds = {r["name_id"]: r["bound"] for r in affinity.name_bounds(lines).collect()}
    assert all(r["times"] <= min(bounds[r["a"]], bounds[r["b"]]) for r in affinity._by_chunks(lines, 1000).collect())
