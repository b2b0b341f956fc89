import pytest
from pyspark.sql import functions as F

from tillwise.operators import integrity, quality


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_audit_counts_copies_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a INT, b STRING")
    got = {r["column_name"]: r for r in quality.audit(df, "t").collect()}
    assert got["b"]["row_count"] == 3 and got["b"]["null_count"] == 2
    assert got["a"]["duplicate_rows"] == 1 and got["a"]["null_count"] == 0


def test_exact_duplicates_keep_their_count(spark):
    df = spark.createDataFrame([(1, None)] * 3 + [(2, "x")], "a INT, b STRING")
    got = rows(quality.drop_exact_duplicates(df, "_dq_copies"), "a")
    assert got == [(1, None, 2), (2, "x", 0)]
    assert quality.drop_exact_duplicates(df).count() == 2


def test_rows_that_share_a_hash_both_stay(spark):
    """All rows collide here, and still only equal ones fold."""
    df = spark.createDataFrame([(1, None)] * 3 + [(2, "x"), (None, "x"), (2, "x"), (4, "y")], "a INT, b STRING")

    def one_hash(_):
        return F.lit(7).cast("bigint")

    got = rows(quality.drop_exact_duplicates(df, "_dq_copies", row_hash=one_hash), "a", "b")
    assert got == [(None, "x", 0), (1, None, 2), (2, "x", 1), (4, "y", 0)]
    assert got == rows(quality.drop_exact_duplicates(df, "_dq_copies", by_hash=False), "a", "b")
    assert got == rows(quality.drop_exact_duplicates(df, "_dq_copies"), "a", "b")
    profile = quality.audit(df, "t", one_hash).collect()
    assert sorted(profile) == sorted(quality.audit(df, "t").collect()) and profile[0]["duplicate_rows"] == 3


def test_unique_rows_are_not_grouped_by_their_columns(spark):
    """The plan's shuffles carry hashes; whole rows are compared behind a semi join on repeated hashes."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang")
    plan = quality.drop_exact_duplicates(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan and "Aggregate [_hash" in plan
    got = quality.drop_exact_duplicates(df)
    assert got.count() == df.distinct().count()


def test_dense_numbers_with_a_hot_first_key(spark):
    """90 % of the rows under one first key, with ties and NULLs."""
    df = spark.range(5_000).selectExpr("IF(id % 10 = 0, NULL, 3) AS a", "id * 7919 % 1009 AS b", "id % 3 AS c")
    got = quality.dense_id(df, ["a", "b"], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 5_001))
    keys = [(r["a"] is not None, r["a"] or 0, r["b"], r["c"]) for r in got]
    assert keys == sorted(keys)


def test_key_dedup_is_the_row_number_rule(spark):
    data = [(5, "m", "e"), (3, "z", "e"), (9, "q", None), (8, "q", None), (1, "k", "f")]
    df = spark.createDataFrame(data, "id INT, other STRING, key STRING")
    keep = rows(quality.dedup_by_key(df, "key", "id"), "id")
    assert keep == [(1, "k", "f"), (3, "z", "e"), (8, "q", None), (9, "q", None)]
    collapse = rows(quality.dedup_by_key(df, "key", "id", null_key="collapse", mark="_dq_n"), "id")
    assert collapse == [(1, "k", "f", 0), (3, "z", "e", 1), (8, "q", None, 1)]
    with pytest.raises(ValueError):
        quality.dedup_by_key(df, "key", "id", null_key="drop")


def test_approximate_fences_are_near_the_exact_ones(spark):
    df = spark.range(20_000).selectExpr("id % 3 AS g", "double(id * 7919 % 20011) AS x")
    exact = {r["g"]: r for r in quality.iqr_fences(df, "x", by=["g"]).collect()}
    for r in quality.iqr_fences(df, "x", by=["g"], approx=True).collect():
        assert abs(r["q1"] - exact[r["g"]]["q1"]) <= 20 and abs(r["upper"] - exact[r["g"]]["upper"]) <= 80


def test_constant_column_has_no_outliers(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x DOUBLE")
    assert {r["z_outlier"] for r in quality.zscore_flag(df, "x").collect()} == {False}
    fences = quality.iqr_fences(df, "x").collect()[0]
    assert (fences["lower"], fences["upper"]) == (2.0, 2.0)


def test_cap_touches_only_the_upper_side_and_keeps_nulls(spark):
    values = ["1.00"] + ["10.00"] * 10 + ["12.00"] * 10 + ["900.00", None]
    df = spark.createDataFrame([(v,) for v in values], "v STRING").select(
        F.col("v").cast("decimal(18,2)").alias("x"))
    got = quality.cap_outliers(df, "x", mark="_dq_capped").collect()
    assert sum(r["_dq_capped"] for r in got) == 1
    numbers = sorted(float(r["x"]) for r in got if r["x"] is not None)
    assert numbers[0] == 1.0 and numbers[-1] == 15.0
    assert sum(r["x"] is None for r in got) == 1


def test_low_z_score_is_capped_to_the_upper_fence(spark):
    values = ["-900.00"] + ["10.00"] * 20 + ["12.00"] * 20
    df = spark.createDataFrame([(v,) for v in values], "v STRING").select(
        F.col("v").cast("decimal(18,2)").alias("x"))
    got = quality.cap_outliers(df, "x", "iqr_or_z").agg(F.min("x")).collect()[0][0]
    assert float(got) == 10.0


def test_group_median_leaves_empty_groups(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 4.0), ("a", None), ("b", None), (None, None)], "g STRING, x DOUBLE")
    got = quality.impute_group_median(df, "x", "g").collect()
    assert sorted(r["x"] for r in got if r["g"] == "a") == [1.0, 2.5, 4.0]
    assert [r["x"] for r in got if r["g"] != "a"] == [None, None]


def test_null_when_ignores_unknown_conditions(spark):
    df = spark.createDataFrame(
        [("2023-01-05", "2023-01-02"), ("2023-01-05", "2023-01-05"), (None, "2023-01-02"),
         ("2023-01-05", None)], "ordered STRING, shipped STRING")
    got = quality.null_when(df, ["shipped"], F.col("shipped") < F.col("ordered"))
    assert [r["shipped"] for r in got.collect()] == [None, "2023-01-05", "2023-01-02", None]


def test_orphans_are_split_and_counted(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 99)], "id INT, k INT")
    parent = spark.createDataFrame([(10,), (11,)], "k INT")
    kept, rejected = integrity.split_orphans(child, parent, "k")
    assert (kept.count(), rejected.count()) == (1, 3)
    report = integrity.fk_report([("child", child, "parent", parent, "k")]).collect()
    assert [tuple(r) for r in report] == [("child", "parent", "k", 2)]


def test_dense_id_has_no_gaps(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3 % 1000).alias("v"))
    got = quality.dense_id(df, ["v"], "n").orderBy("v").collect()
    assert [r["n"] for r in got] == list(range(1, 1001))
