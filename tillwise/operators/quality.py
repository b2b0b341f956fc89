"""Cleaning rules. Each takes a DataFrame first, so rules chain with ``DataFrame.transform``.

Rules that change or drop rows can leave a count column (``_dq_…``) behind; the quality report
adds those up in the one pass that writes the table, instead of one count per rule.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions import money
from tillwise.operators.quantiles import exact_quantiles, range_buckets

MARK = "_dq_"
RowHash = Callable[[DataFrame], Column]


def row_hash(df: DataFrame) -> Column:
    """64 bits over all columns; NULL leaves the hash as it is, so the columns that are NULL are hashed too."""
    names = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*names, *[c.isNull() for c in names])


def _repeated(df: DataFrame, row_hash: RowHash) -> tuple[DataFrame, DataFrame]:
    """``df`` with its ``_hash``, and the hashes that more than one row has."""
    hashed = df.withColumn("_hash", row_hash(df))
    return hashed, hashed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")


def audit(df: DataFrame, table: str, row_hash: RowHash = row_hash) -> DataFrame:
    """Profile: one row per column with rows, nulls, null share and full-row duplicates.

    Rows and nulls are added up where the rows are. For the duplicates only hashes are grouped; rows whose hash
    repeats, and no others, are then compared whole.
    """
    names = df.columns
    nulls = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"_null_{i}") for i, c in enumerate(names)]
    hashed, repeated = _repeated(df, row_hash)
    copies = (
        hashed.join(repeated, "_hash", "left_semi").groupBy("_hash", *[f"`{c}`" for c in names]).agg((F.count("*") - 1).alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    )
    totals = df.agg(F.count("*").alias("row_count"), *nulls).withColumn("duplicate_rows", copies)
    per_column = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_null_{i}").alias("null_count"))
            for i, c in enumerate(names)
        ])
    )
    return totals.select("row_count", "duplicate_rows", per_column.alias("p")).select(
        F.lit(table).alias("table_name"), "p.column_name", "row_count", "p.null_count",
        (F.col("p.null_count") * 100.0 / F.nullif("row_count", F.lit(0))).alias("null_pct"),
        "duplicate_rows",
    )


def drop_exact_duplicates(
    df: DataFrame, mark: str | None = None, by_hash: bool = True, row_hash: RowHash = row_hash
) -> DataFrame:
    """Keep one of every set of equal rows; ``mark`` keeps the number of dropped copies.

    Rows are grouped by a 64-bit hash alone, and a row whose hash no other row has stays where it is. The others are
    compared whole, so rows that merely share a hash both stay. Without ``by_hash`` all rows are grouped by all of their
    columns in one pass over the input: for narrow rows that cost more to read three times than to move once.
    """
    if by_hash:
        hashed, repeated = _repeated(df, row_hash)
        names = [F.col(f"`{c}`") for c in df.columns]
        single = hashed.join(repeated, "_hash", "left_anti").select(*names, F.lit(0).cast("bigint").alias("_copies"))
        folded = hashed.join(repeated, "_hash", "left_semi").groupBy("_hash", *names).agg((F.count("*") - 1).alias("_copies"))
        out = single.unionByName(folded.drop("_hash"))
        return out.drop("_copies") if mark is None else out.withColumnRenamed("_copies", mark)
    if mark is None:
        return df.dropDuplicates()
    # The condition always holds. It keeps the count in every branch of a plan, so that branches
    # which do not show it still share one shuffle of the rows with those that do.
    return df.groupBy(*df.columns).agg((F.count("*") - 1).alias(mark)).where(F.col(mark) >= 0)


def dedup_by_key(
    df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str],
    null_key: str = "keep", mark: str | None = None,
) -> DataFrame:
    """First row per key in ``order_by`` order, ties by the remaining columns.

    A minimum over whole rows, so copies of a heavy key combine before the shuffle; a
    row_number window would sort such a key in one task. Rows without a key all stay
    (``null_key="keep"``) or count as one key (``"collapse"``). Count columns left by earlier
    rules are added up over the copies.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    marks = [c for c in df.columns if c.startswith(MARK)]
    rest = [c for c in df.columns if c not in {*keys, *order, *marks}]
    aggs = [F.min(F.struct(*order, *rest)).alias("_first")]
    aggs += [F.sum(m).alias(m) for m in marks]
    if mark:
        aggs.append((F.count("*") - 1).alias(mark))
    kept = [c for c in df.columns if c not in marks] + marks + ([mark] if mark else [])

    def first_rows(part: DataFrame) -> DataFrame:
        grouped = part.groupBy(*keys).agg(*aggs)
        return grouped.select(*[c for c in grouped.columns if c != "_first"], "_first.*").select(
            *kept
        )

    if null_key == "collapse":
        return first_rows(df)
    if null_key != "keep":
        raise ValueError("null_key is 'keep' or 'collapse'")
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    untouched = df.where(no_key)
    if mark:
        untouched = untouched.withColumn(mark, F.lit(0).cast("bigint"))
    return first_rows(df.where(~no_key)).unionByName(untouched.select(*kept))


def enforce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def flag(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """0/1 column; an unknown condition is 0."""
    return df.withColumn(name, F.coalesce(condition.cast("int"), F.lit(0)))


def null_when(df: DataFrame, cols: Sequence[str], condition: Column) -> DataFrame:
    """NULL the columns where the condition holds; an unknown condition changes nothing."""
    holds = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(~holds, F.col(c)) for c in cols})


def abs_values(df: DataFrame, cols: Sequence[str], zero_to: int | None = None) -> DataFrame:
    changed = {}
    for c in cols:
        value = F.abs(F.col(c))
        if zero_to is not None:
            value = F.when(value == 0, F.lit(zero_to)).otherwise(value)
        changed[c] = value
    return df.withColumns(changed)


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def iqr_fences(
    df: DataFrame, col: str, k: float = 1.5, by: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """(*by, q1, q3, lower, upper); ``approx`` takes elements from a sketch, in one pass."""
    if approx:
        found = df.groupBy(*by).agg(
            F.percentile_approx(F.col(col).cast("double"), [0.25, 0.75], 10000).alias("q")
        )
    else:
        found = exact_quantiles(df, col, (0.25, 0.75), by)
    q1, q3 = F.element_at("q", 1), F.element_at("q", 2)
    reach = (q3 - q1) * k
    return found.select(
        *by, q1.alias("q1"), q3.alias("q3"),
        (q1 - reach).alias("lower"), (q3 + reach).alias("upper"),
    )


def zscore_flag(
    df: DataFrame, col: str, threshold: float = 3.0, name: str = "z_outlier"
) -> DataFrame:
    """True where the value is more than ``threshold`` sample deviations off the mean.

    All False for a constant column.
    """
    value = F.col(col).cast("double")
    stats = df.agg(
        F.struct(F.avg(value).alias("mu"), F.stddev_samp(value).alias("sigma"))
    ).scalar()
    mu, sigma = F.col("_z.mu"), F.col("_z.sigma")
    score = F.abs(value - mu) / F.nullif(sigma, F.lit(0.0))
    return df.withColumn("_z", stats).select(
        *df.columns, F.coalesce(score > threshold, F.lit(False)).alias(name)
    )


def cap_outliers(
    df: DataFrame, col: str, method: str = "iqr", mark: str | None = None
) -> DataFrame:
    """Set money values over the upper IQR fence to the fence (rounded to cents).

    ``iqr_or_z`` also caps what the z-score calls an outlier, on either side. The fence is a
    scalar subquery: one row, part of the plan.
    """
    if method not in ("iqr", "iqr_or_z"):
        raise ValueError("method is 'iqr' or 'iqr_or_z'")
    upper = iqr_fences(df, col).select("upper").scalar()
    out = zscore_flag(df, col, name="_far") if method == "iqr_or_z" else df.withColumn(
        "_far", F.lit(False)
    )
    out = out.withColumn("_upper", upper)
    over = F.coalesce(F.col(col).cast("double") > F.col("_upper"), F.lit(False)) | F.col("_far")
    capped = F.when(over, money(F.col("_upper"))).otherwise(F.col(col))
    marks = [over.cast("bigint").alias(mark)] if mark else []
    return out.select(*[capped.alias(c) if c == col else c for c in df.columns], *marks)


def impute_group_median(df: DataFrame, col: str, by: str) -> DataFrame:
    """NULL becomes the median of its group; a group without values stays NULL.

    The medians travel as one map, so the rows of a heavy group stay where they are.
    """
    medians = exact_quantiles(df.where(F.col(by).isNotNull()), col, [0.5], [by]).agg(
        F.map_from_entries(F.collect_list(F.struct(by, F.element_at("q", 1))))
    ).scalar()
    return df.withColumn("_medians", medians).withColumn(
        col, F.coalesce(col, F.col("_medians")[F.col(by)])
    ).select(*df.columns)


def impute_from_lookup(
    df: DataFrame, col: str, lookup: DataFrame, on: str, lookup_col: str
) -> DataFrame:
    """NULL becomes the lookup's value for the key; ``lookup`` is unique on ``on``."""
    values = lookup.select(on, F.col(lookup_col).alias("_found"))
    return df.join(values, on, "left").withColumn(col, F.coalesce(col, "_found")).select(
        *df.columns
    )


def add_date_parts(df: DataFrame, col: str = "order_date") -> DataFrame:
    d = F.col(col)
    return df.withColumns({
        "order_year": F.year(d),
        "order_month": F.date_format(d, "yyyy-MM"),
        "order_dow": F.date_format(d, "EEEE"),
    })


def dense_id(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Renumber rows 1..n in ``order_by`` order, without one window over the whole table.

    Splitters over the whole order deal the rows into ranges, so that a first key with most of the rows is split by the next
    ones; rows are numbered inside their range and shifted by the size of the ranges before it, in one lazy plan. Rows that
    tie in ``order_by`` go by the remaining columns, so only equal rows are interchangeable.
    """
    rest = [f.name for f in df.schema.fields if f.name not in order_by and f.dataType.typeName() not in ("map", "variant")]
    order = [*order_by, *rest]
    parts = range_buckets(df, order, "_bucket")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_bucket").agg(F.count("*").alias("_size")).select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        parts.withColumn("_row", F.row_number().over(inside))
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_row") + F.col("_before"))
        .select(*dict.fromkeys([*df.columns, name]))
    )


def report_rows(staged: DataFrame, table: str) -> DataFrame:
    """Quality log of one staged table: (table_name, rule, affected), one aggregation."""
    marks = [c for c in staged.columns if c.startswith(MARK)]
    sums = staged.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in marks])
    entries = F.explode(
        F.array(*[
            F.struct(F.lit(m.removeprefix(MARK)).alias("rule"), F.col(m).alias("affected"))
            for m in marks
        ])
    )
    return sums.select(entries.alias("e")).select(
        F.lit(table).alias("table_name"), "e.rule", "e.affected"
    )


def quality_report(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Quality log over all staged tables."""
    return reduce(
        DataFrame.unionByName, [report_rows(df, table) for table, df in stages.items()]
    )


def without_marks(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(MARK)])
