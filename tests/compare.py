"""Run a registered query in Spark and its counterpart in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime) and value.time() == dt.time(0):
        return value.date()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else the first difference."""
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    answer = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in answer.description], answer.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first: {got_cols} {bad[0][0]} != {bad[0][1]}"
    kinds = {type(v).__name__ for row in want for v in row}
    spark_kinds = {type(v).__name__ for row in got for v in row}
    if kinds != spark_kinds:
        return f"types {spark_kinds} != {kinds}"
    return None
