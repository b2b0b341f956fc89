import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tillwise.operators import quantiles
from tillwise.operators.quantiles import (
    exact_quantiles, quantile_scores, range_buckets, running_share_by_value,
)
from tillwise.operators.shaping import box_stats, histogram

PROBS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.8, 1.0]


def frame(n, seed=1):
    rng = np.random.default_rng(seed)
    values = np.round(rng.lognormal(3, 1, n), 2)
    values[: n // 3] = 7.5  # a third of all rows hold one value
    return pd.DataFrame({"g": rng.integers(0, 3, n), "x": values})


@pytest.mark.parametrize("n", [1, 2, 3, 5, 11, 101, 4000])
def test_quantiles_equal_pandas(spark, n):
    pdf = frame(n)
    row = exact_quantiles(spark.createDataFrame(pdf), "x", PROBS).collect()[0]
    assert row["n"] == n
    assert np.allclose(row["q"], pdf.x.quantile(PROBS))


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize(("k", "spread"), [(8, -0.01), (8, 0.0), (16, 0.1), (4096, 8.0)])
def test_quantiles_by_group_with_any_sketch(spark, monkeypatch, k, spread, many):
    """Sketches far too coarse, whose brackets miss the wanted ranks, still lead to exact values."""
    monkeypatch.setattr(quantiles, "SMALL", 0)
    pdf = frame(3000)
    pdf.loc[::500, "x"] *= 1e6
    got = exact_quantiles(spark.createDataFrame(pdf), "x", [0.25, 0.5], ["g"], k, spread, many).collect()
    assert len(got) == pdf.g.nunique()
    for row in got:
        assert np.allclose(row["q"], pdf[pdf.g == row["g"]].x.quantile([0.25, 0.5]))


def test_values_over_600_decades(spark):
    """Brackets follow the ranks, so that a wide spread of values leaves few of them to be counted one by one."""
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"x": 10.0 ** rng.uniform(-300, 300, 60_000) * rng.choice([-1, 1], 60_000)})
    df = spark.createDataFrame(pdf).withColumn("g", F.struct(F.lit(0).alias("all"))).withColumnRenamed("x", "v")
    row = exact_quantiles(df, "v", PROBS).collect()[0]
    assert np.allclose(row["q"], pdf.x.quantile(PROBS), rtol=1e-12)
    counted = quantiles._counted(df, quantiles._brackets(df, [0.25, 0.5, 0.75], quantiles.SKETCH, quantiles.SPREAD), [0.25, 0.5, 0.75], False)
    assert counted.count() < 0.06 * len(pdf)
    assert counted.agg(F.sum("cnt")).first()[0] == len(pdf)


def test_the_widening_pass_is_dropped_without_misses(spark):
    """At run time the input is read twice: once for the sketches, once for the counts."""
    df = spark.read.schema("l_orderkey BIGINT, l_extendedprice DOUBLE").parquet("/root/testdata/sf0.001/lineitem.parquet")
    out = exact_quantiles(df, "l_extendedprice", [0.25, 0.5, 0.75])
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") + final.count("Scan parquet") <= 2


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (float("inf"),)], "x DOUBLE")
    assert exact_quantiles(df, "x", [0.5]).collect()[0]["q"] == [3.0]


def test_null_values_and_null_groups(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", 3.0), (None, 5.0), ("b", None)], "g STRING, x DOUBLE")
    got = {r["g"]: r["q"] for r in exact_quantiles(df, "x", [0.5], ["g"]).collect()}
    assert got == {"a": [2.0], None: [5.0]}


def test_scores_equal_qcut(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"low": rng.integers(0, 900, 2000), "high": rng.integers(1, 14, 2000)})
    got = quantile_scores(spark.createDataFrame(pdf), {"low": True, "high": False}).toPandas()
    assert (got.low_score == pd.qcut(got.low, 5, labels=[5, 4, 3, 2, 1]).astype(int)).all()
    assert (got.high_score == pd.qcut(got.high, 5, labels=[1, 2, 3, 4, 5]).astype(int)).all()


def test_scores_with_null_and_repeated_edges(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (3, 1), (4, 1), (5, 9)], "a INT, b INT")
    plain = quantile_scores(df, {"a": True, "b": False}).collect()
    assert [r["a_score"] for r in plain if r["a"] is None] == [1]
    assert {r["b_score"] for r in plain if r["b"] == 1} == {1}
    strict = quantile_scores(df, {"a": True, "b": False}, strict=3).collect()
    assert {(r["a_score"], r["b_score"]) for r in strict} == {(3, 3)}


def test_running_share_counts_ties_together(spark):
    pdf = frame(2500)
    got = running_share_by_value(spark.createDataFrame(pdf), "x", buckets=20).toPandas()
    got = got.sort_values("x", ascending=False)
    want = pdf.groupby("x").x.sum().sort_index(ascending=False).cumsum()
    assert len(got) == len(want)
    assert np.allclose(got.upto.astype(float), want.values)
    assert np.allclose(got.total.astype(float), pdf.x.sum())


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 9.0, 10.0], [4.0, 4.0, 4.0]])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    got = histogram(df, "x", 4).orderBy("bin").toPandas()
    counts, edges = np.histogram(values, bins=4)
    assert got.n.tolist() == counts.tolist()
    assert np.allclose(got.lower, edges[:-1]) and np.allclose(got.upper, edges[1:])


def test_box_whiskers_stay_inside_fences(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 2.0)] * 3
    got = {r["g"]: r for r in box_stats(
        spark.createDataFrame(rows, "g STRING, x DOUBLE"), "x", "g").collect()}
    assert (got["a"]["whisker_low"], got["a"]["whisker_high"], got["a"]["outliers"]) == (1, 5, 1)
    assert (got["b"]["whisker_low"], got["b"]["whisker_high"], got["b"]["outliers"]) == (2, 2, 0)
    assert got["a"]["median"] == 3.5


def test_range_buckets_rise_with_the_value_and_are_even(spark):
    pdf = frame(4000)
    pdf.loc[0, "x"] = 1e9
    got = range_buckets(spark.createDataFrame(pdf), "x", "b", 64).toPandas().sort_values("x")
    assert got.b.is_monotonic_increasing
    others = got[got.x != 7.5]
    assert others.groupby("b").size().max() <= 4000 / 10


def test_no_range_is_over_twice_the_mean(spark):
    """Log-normal values with dense clusters that fill a thousandth of the spread, and NULLs."""
    rng = np.random.default_rng(11)
    n = 40_000
    clusters = 50 + rng.integers(0, 4, n) * 1000 + rng.random(n) * 1e-3
    pdf = pd.DataFrame({"x": np.where(rng.random(n) < 0.7, clusters, rng.lognormal(3, 2, n))})
    df = spark.createDataFrame(pdf).unionAll(spark.sql("SELECT CAST(NULL AS DOUBLE) AS x"))
    got = range_buckets(df, "x", "b", 64).toPandas()
    assert got[got.x.isna()].b.tolist() == [0]
    got = got[got.x.notna()].sort_values("x")
    assert got.b.is_monotonic_increasing and got.b.nunique() == 64
    assert got.groupby("b").size().max() <= 2 * n / 64


def test_ranges_split_a_hot_first_key(spark):
    df = spark.range(20_000).selectExpr("IF(id % 10 = 0, id, 5) AS a", "id * 7919 % 20011 AS b")
    got = range_buckets(df, ["a", "b"], "r", 32).toPandas().sort_values(["a", "b"])
    assert got.r.is_monotonic_increasing
    assert got.groupby("r").size().max() <= 2 * 20_000 / 32
    empty = range_buckets(df.where("a < 0"), ["a", "b"], "r", 32)
    assert empty.collect() == [] and range_buckets(df, "a", "r", 1).select("r").distinct().collect() == [(0,)]
