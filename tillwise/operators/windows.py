"""Growth, running and rolling figures, ranks, shares and top-n.

The un-partitioned windows here are meant for small aggregates (days, months, categories,
states); per-customer and per-product data goes through ``top_n`` or the quantile operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions import ratio, round_half


def _window(order_by: str | None = None, partition_by: str | Sequence[str] | None = None):
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    spec = Window.partitionBy(*keys)
    return spec.orderBy(order_by) if order_by else spec


def growth(
    df: DataFrame, value: str, order_by: str, previous: str, change: str | None = None,
    growth_pct: str | None = None, partition_by: str | Sequence[str] | None = None,
    offset: int = 1, places: int | None = 2,
) -> DataFrame:
    """Previous row's value, the difference and the growth in percent of the previous value."""
    df = df.withColumn(previous, F.lag(value, offset).over(_window(order_by, partition_by)))
    diff = F.col(value) - F.col(previous)
    if change:
        df = df.withColumn(change, round_half(diff, places) if places is not None else diff)
    if growth_pct:
        df = df.withColumn(growth_pct, ratio(diff, previous, 100.0, places))
    return df


def running_total(value: str, order_by: str, partition_by: str | None = None) -> Column:
    spec = _window(order_by, partition_by).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(spec)


def rolling_rows(value: str, n: int, order_by: str, fn=F.avg) -> Column:
    """Aggregate over this row and the n - 1 rows before it."""
    return fn(value).over(_window(order_by).rowsBetween(-(n - 1), 0))


def rolling_days(value: str, days: int, date: str, fn=F.sum) -> Column:
    """Aggregate over the ``days`` calendar days that end on this row's date.

    A RANGE frame over day numbers: one sort, where a date-range self join would compare
    every day with every other.
    """
    day_number = F.unix_date(F.col(date))
    return fn(value).over(Window.orderBy(day_number).rangeBetween(-(days - 1), 0))


def rank_by(value: str, kind: str = "rank", partition_by: str | None = None) -> Column:
    """rank / dense_rank / row_number by descending value, as BIGINT."""
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[kind]
    keys = [partition_by] if partition_by else []
    return fn().over(Window.partitionBy(*keys).orderBy(F.desc(value))).cast("bigint")


def top_n(
    df: DataFrame, n: int, value: str, tie_break: Sequence[str], rank: str | None = None
) -> DataFrame:
    """The n rows with the largest value, ties by the given keys; numbered after the cut."""
    keys = [F.desc(value), *[F.asc(k) for k in tie_break]]
    top = df.orderBy(*keys).limit(n)
    if rank:
        top = top.withColumn(rank, F.row_number().over(Window.orderBy(*keys)).cast("bigint"))
    return top


def share_of_total(value: str, within: str | None = None) -> Column:
    """value / sum of value over everything (or within a key), as DOUBLE."""
    return ratio(F.col(value), F.sum(value).over(_window(partition_by=within)))
