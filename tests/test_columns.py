import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwise import functions as fn
from tillwise.schema import ISO_DATE, KNOWN_DATES, TIER_SPELLINGS


def values(spark, rows, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i INT, x STRING")
    return [r[0] for r in df.orderBy("i").select(expression.alias("y")).collect()]


def test_title_case_runs_and_words(spark):
    rows = ["JOHN", "o'neil", " anne-marie ", "men's apparel", None, ""]
    assert values(spark, rows, fn.title_case("x", parity=True)) == [
        "John", "O'Neil", "Anne-Marie", "Men'S Apparel", None, ""]
    assert values(spark, rows, fn.title_case("x")) == [
        "John", "O'neil", "Anne-marie", "Men's Apparel", None, ""]


def test_email_repair_needs_word_breaks_unless_loose(spark):
    rows = ["joeATexampleDOTcom", "Joe@example DOT com", "no-at-sign", "a@b", None, " J@X.IO "]
    assert values(spark, rows, fn.repair_email("x")) == [
        None, "joe@example . com", None, None, None, "j@x.io"]
    assert values(spark, rows, fn.repair_email("x", loose=True))[0] == "joe@example.com"


def test_phone_digits(spark):
    rows = ["(555) 123-4567x89", "555-12", None, "1234567", "123456"]
    assert values(spark, rows, fn.digits_only("x")) == [
        "555123456789", None, None, "1234567", None]


def test_money_text(spark):
    rows = ["$12.50", "12.50 USD", "", "abc", "-5", "1.2.3", None]
    got = [None if v is None else float(v) for v in values(spark, rows, fn.parse_money("x"))]
    assert got == [12.5, 12.5, None, None, 5.0, None, None]


def test_dates_strict_and_all_layouts(spark):
    rows = ["2023-03-15", "03/15/2023", "2023.03.15", "03-15-2023", "15 Mar 2023", "12-/4/98-", None]
    day = dt.date(2023, 3, 15)
    assert values(spark, rows, fn.parse_date("x", ISO_DATE)) == [day] + [None] * 6
    assert values(spark, rows, fn.parse_date("x", KNOWN_DATES)) == [day] * 5 + [None, None]


def test_standardise_keeps_unknown_values(spark):
    rows = ["GOLD", "Bronz", "Diamond", None]
    assert values(spark, rows, fn.standardise("x", TIER_SPELLINGS)) == [
        "Gold", "Bronze", "Diamond", None]


def test_clip_and_fill(spark):
    number = F.col("x").try_cast("double")
    assert values(spark, ["-0.1", "1.4", None, "0.3"], fn.clip_fill(number, 0.0, 1.0, 0.0)) == [
        0.0, 1.0, 0.0, 0.3]


def test_bucket_bounds_are_inclusive_and_null_goes_last(spark):
    number = F.col("x").try_cast("int")
    labels = ("one", "few", "some", "many", "most")
    assert values(spark, ["1", "3", "6", "10", "11", None], fn.bucketize(
        number, (1, 3, 6, 10), labels)) == ["one", "few", "some", "many", "most", "most"]


def test_ratio_guards(spark):
    number = F.col("x").try_cast("int")
    assert values(spark, ["0", "4", None], fn.ratio(F.lit(1), number)) == [None, 0.25, None]
    assert values(spark, ["0"], fn.ratio(F.lit(1), number, default=0.0)) == [0.0]


@pytest.mark.parametrize("day,week", [
    ("2023-01-01", 1), ("2023-01-07", 1), ("2023-01-08", 2), ("2022-01-01", 1), ("2022-01-02", 2),
    ("2024-12-31", 53),
])
def test_week_number_starts_on_sunday(spark, day, week):
    assert values(spark, [day], fn.week_number(F.to_date("x"))) == [week]


def test_month_index_counts_calendar_months(spark):
    assert values(spark, ["2023-03-01"], fn.month_index(
        F.to_date("x"), F.lit(dt.date(2021, 12, 31)))) == [15]


def test_line_total_and_cents(spark):
    total = fn.line_total(F.lit(3), F.col("x").cast("decimal(18,2)"), F.lit("0.15").cast("decimal(5,4)"))
    assert [float(v) for v in values(spark, ["19.99", "0.01"], total)] == [50.97, 0.03]
    assert values(spark, ["19.99"], fn.cents(F.col("x").cast("decimal(18,2)"))) == [1999]
    assert values(spark, ["1999"], fn.dollars(F.col("x").cast("bigint"))) == [19.99]
