"""Exact quantiles and value-ordered running sums without gathering a column in one task.

The built-in ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here the
input is evaluated twice, whatever the number of probabilities: sketches bracket the wanted ranks, and one
counting pass counts single values inside the brackets and everything else by the gap it lies in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

SKETCH = 4096  # k of the KLL sketches
MERGERS = 256  # tasks that merge a group's sketches before one task does
SPREAD = 8.0  # a bracket reaches so many times the sketch's rank error to each side
PER_BUCKET = 64  # sampled keys for each range of ``range_buckets``
SMALL = 2048  # rows; smaller groups are counted value by value, as ranks are coarser than the error there


def _rank_error(k: int) -> float:
    """Share of the rows by which a rank of a KLL sketch is off, at 99 % (the sketch's published fit)."""
    return 2.296 / k ** 0.9723


# SQL text below, not column objects: each of these would take a dozen calls to the JVM for every probability.

def _rank(p: float) -> str:
    """0-based rank just below the quantile's position."""
    return f"floor((n - 1) * {p!r}D)"


def _ranks(probs: Sequence[float]) -> list[str]:
    """Ranks on both sides of each quantile's position."""
    return [r for p in probs for r in (_rank(p), f"least({_rank(p)} + 1, n - 1)")]


def _holds(rank: str) -> str:
    return f"(before <= {rank} AND {rank} < before + cnt)"


def _brackets(values: DataFrame, probs: Sequence[float], k: int, spread: float) -> DataFrame:
    """(g, n, lows, highs): for each probability a range of values that holds both its ranks, but for rare misses.

    Each task sketches its own rows; MERGERS tasks merge these sketches for each group, then one merges theirs.
    """
    some = values.groupBy("g", (F.spark_partition_id() % MERGERS).alias("merger")).agg(
        F.kll_sketch_agg_double("v", k).alias("sketch"), F.count("*").alias("n"),
        F.min("v").alias("least"), F.max("v").alias("most"),
    )
    merged = some.groupBy("g").agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    )
    margin = spread * _rank_error(k)

    def at(rank: float, end: str) -> str:  # a sketch takes constant ranks only
        if not 0 < rank < 1:
            return end
        return f"CASE WHEN n < {SMALL} THEN {end} ELSE kll_sketch_get_quantile_double(sketch, {rank!r}D) END"

    return merged.selectExpr(
        "g", "n", f"array({', '.join(at(p - margin, 'least') for p in probs)}) AS lows",
        f"array({', '.join(at(p + margin, 'most') for p in probs)}) AS highs",
    )


def _counted(values: DataFrame, brackets: DataFrame, probs: Sequence[float], many: bool) -> DataFrame:
    """(g, n, gap, v, cnt, least, most, before): rows by single value inside a bracket, by gap elsewhere (v is null).

    ``before`` is the number of the group's rows below. The window sees what lies in the brackets, a few thousandths of
    a group's distinct values, and one row a gap.
    """
    if many:
        rows = values.join(brackets.selectExpr("g AS _g", "struct(n, lows, highs) AS s"), F.col("g") == F.col("_g")).drop("_g")
    else:
        every = brackets.agg(F.map_from_entries(F.collect_list(F.struct("g", F.struct("n", "lows", "highs"))))).scalar()
        rows = values.select("g", "v", every.alias("_all")).selectExpr("g", "v", "_all[g] AS s")
    places = range(len(probs))
    inside = " OR ".join(f"v BETWEEN s.lows[{i}] AND s.highs[{i}]" for i in places)
    gap = " + ".join(f"int(v >= s.lows[{i}]) + int(v > s.highs[{i}])" for i in places)
    counted = rows.selectExpr("g", "s.n AS n", f"{gap} AS gap", f"CASE WHEN {inside} THEN v END AS single", "v").groupBy(
        "g", "n", "gap", "single"
    ).agg(F.count("*").alias("cnt"), F.min("v").alias("least"), F.max("v").alias("most"))
    return counted.selectExpr(
        "g", "n", "gap", "single AS v", "cnt", "least", "most",
        "coalesce(sum(cnt) OVER (PARTITION BY g ORDER BY least ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
    )


def exact_quantiles(
    df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
    k: int = SKETCH, spread: float = SPREAD, many: bool = False,
) -> DataFrame:
    """Linear-interpolation quantiles per group: (*by, n, q array<double>).

    Equal to pandas ``quantile`` and ANSI ``percentile_cont``. NULLs and NaNs do not count; a group without
    values has no row. The brackets reach the rows as one map, so that rows of a heavy group are never
    joined; with ``many`` groups they are joined by group instead. A rank that a bracket misses lies in
    a gap; the bracket is then widened to that gap, whose values are counted in a further pass. Without
    misses its side of the join is empty, and the adaptive planner drops the pass.
    """
    by = list(by)
    probs = [float(p) for p in probs]
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    values = df.select(group.alias("g"), F.col(col).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    counted = _counted(values, _brackets(values, probs, k, spread), probs, many)
    ranks = _ranks(probs)
    missed = counted.where(f"v IS NULL AND ({' OR '.join(map(_holds, ranks))})").selectExpr(
        "g AS _g", "n", "gap", "least", "most", "before"
    )
    # At most two rows for each probability of a group, and none but by rare chance.
    wide = values.join(F.broadcast(missed), F.expr("g = _g AND v BETWEEN least AND most"))
    again = wide.groupBy("g", "n", "gap", "before", "v").agg(F.count("*").alias("cnt")).selectExpr(
        "g", "n", "v", "cnt",
        "before + coalesce(sum(cnt) OVER (PARTITION BY g, gap ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
    )
    found = counted.where("v IS NOT NULL").select("g", "n", "v", "cnt", "before").unionByName(again).groupBy("g", "n").agg(
        *[F.expr(f"max(CASE WHEN {_holds(r)} THEN v END) AS r{i}") for i, r in enumerate(ranks)]
    )

    def between(i: int, p: float) -> str:
        share = f"((n - 1) * {p!r}D - {_rank(p)})"
        return f"CASE WHEN {share} > 0 THEN r{2 * i} + (r{2 * i + 1} - r{2 * i}) * {share} ELSE r{2 * i} END"

    return found.selectExpr(
        *[f"g.`{b}` AS `{b}`" for b in by], "n", f"array({', '.join(between(i, p) for i, p in enumerate(probs))}) AS q"
    )


def quantile_scores(
    df: DataFrame, columns: Mapping[str, bool], q: int = 5, strict: int | None = None
) -> DataFrame:
    """Add ``<column>_score``, the quantile bin 1..q, for several columns in one go.

    ``columns`` maps each name to whether low values score high. A score counts the inner
    edges below the value, so equal values score alike; NULL scores 1. With ``strict`` set,
    a column that holds a NULL or has repeated edges scores that constant throughout.
    """
    structs = ", ".join(f"struct('{c}' AS metric, double(`{c}`) AS v)" for c in columns)
    melted = df.select(F.expr(f"explode(array({structs})) AS m")).select("m.metric", "m.v")
    found = exact_quantiles(melted, "v", [i / q for i in range(q + 1)], ["metric"])
    # One row per column, so the collected map is as small as ``columns``.
    edges = found.agg(
        F.map_from_entries(F.collect_list(F.struct("metric", F.struct("n", "q"))))
    ).scalar()
    extra = [edges.alias("_edges")]
    if strict is not None:
        extra.append(df.agg(F.count("*")).scalar().alias("_rows"))
    scores = []
    for name, low_is_best in columns.items():
        cuts = f"_edges['{name}'].q"
        below = " + ".join(f"int(double(`{name}`) > {cuts}[{i}])" for i in range(1, q))
        score = f"CASE WHEN `{name}` IS NULL THEN 1 ELSE {f'{q} - ({below})' if low_is_best else f'{below} + 1'} END"
        if strict is not None:
            complete = f"_edges['{name}'].n = _rows AND size(array_distinct({cuts})) = {q + 1}"
            score = f"CASE WHEN {complete} THEN {score} ELSE {strict} END"
        scores.append(f"int({score}) AS `{name}_score`")
    return df.select("*", *extra).selectExpr(*[f"`{c}`" for c in df.columns], *scores)


def range_buckets(df: DataFrame, by: str | Sequence[str], name: str, buckets: int = 1024) -> DataFrame:
    """Add a number 0..buckets-1 that rises with the order of the columns ``by``, in about equal shares of their distinct values.

    Splitters come from a sample of the whole keys, so a value that heads most rows is split by the columns behind it. The sample
    is drawn by a hash of the key, about PER_BUCKET keys a bucket: the same on every evaluation, and one copy of a key that many rows
    hold. Each row finds its place among the splitters by halving. NULL comes first.
    """
    by = [by] if isinstance(by, str) else list(by)
    key = f"struct({', '.join(f'`{c}`' for c in by)})"
    lot = f"xxhash64({', '.join(f'`{c}`' for c in by)})"
    kinds = df.agg(F.expr(f"approx_count_distinct({lot}, 0.02)")).scalar()
    keys = (
        df.select(F.expr(f"{key} AS k"), F.expr(f"shiftrightunsigned({lot}, 1) / {float(1 << 63)!r}D AS lot"), kinds.alias("kinds"))
        .where(f"lot * kinds < {PER_BUCKET * buckets}").groupBy("k").agg(F.count("*").alias("_rows"))
    )
    splitters = keys.agg(F.sort_array(F.collect_list("k")).alias("ks")).select(F.expr(
        f"transform(sequence(1, {buckets} - 1), i -> get(ks, int(i * size(ks) div {buckets})))" if buckets > 1 else "slice(ks, 1, 0)"
    )).scalar()
    steps = ", ".join(str(1 << k) for k in range(max(buckets - 1, 1).bit_length() - 1, -1, -1))
    # Number of splitters at or below the key; an empty sample's splitters are null.
    place = (
        f"aggregate(array({steps}), 0, (at, step) -> "
        f"if(at + step <= size(_splitters) AND get(_splitters, at + step - 1) <= {key}, at + step, at))"
    )
    return df.withColumn("_splitters", splitters).withColumn(name, F.expr(place)).drop("_splitters")


def running_share_by_value(
    df: DataFrame, value: str, buckets: int = 1024
) -> DataFrame:
    """Per distinct value, largest first: (value, rows, upto = sum of all values >= it, total).

    Equal values count together (RANGE semantics). Values are spread over ranges of about
    equal size; only the sums of the ranges, never the rows, are put in one order.
    """
    distinct = df.where(F.col(value).isNotNull()).groupBy(value).agg(
        F.count("*").alias("rows"), F.sum(value).alias("value_sum")
    )
    bucketed = range_buckets(distinct, value, "bucket", buckets)
    totals = bucketed.groupBy("bucket").agg(F.sum("value_sum").alias("bucket_sum"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("bucket_sum").over(above), F.lit(0)).alias("higher_buckets"),
        F.sum("bucket_sum").over(whole).alias("total"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc(value)).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        bucketed.withColumn("in_bucket", F.sum("value_sum").over(inside))
        .join(offsets, "bucket")
        .select(
            value, "rows", (F.col("in_bucket") + F.col("higher_buckets")).alias("upto"), "total"
        )
    )
