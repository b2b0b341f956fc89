"""Which products are bought together: exact pair counts, cut to the n largest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.operators.star import Star
from tillwise.operators.windows import top_n

SEEDS = 256  # names whose pairs are counted first
CHUNK = 1000  # distinct products of one order that one task pairs with all of the order's


def _folded_lines(star: Star) -> tuple[DataFrame, DataFrame]:
    """(order_id, product_id, name_id, n) folded from the lines, and the names by name_id.

    Products of equal name and category share a name_id, their lowest product_id, so that
    pairs travel as two numbers and strings join at the very end.
    """
    names = star.products.groupBy("product_name", "category").agg(
        F.min("product_id").alias("name_id")
    )
    ids = star.products.select(
        "product_id", F.col("product_name").alias("p_name"), F.col("category").alias("p_category")
    ).join(
        names,
        F.col("p_name").eqNullSafe(F.col("product_name"))
        & F.col("p_category").eqNullSafe(F.col("category")),
    ).select("product_id", "name_id")
    folded = star.lines.groupBy("order_id", "product_id").agg(F.count("*").alias("n"))
    return folded.join(ids, "product_id"), names


def _count_pairs(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """(a, b, times) over line pairs with product a < product b, by name_id."""
    a = left.select(
        *on, F.col("product_id").alias("id_a"), F.col("name_id").alias("a"),
        F.col("n").alias("n_a"),
    )
    b = right.select(
        *on, F.col("product_id").alias("id_b"), F.col("name_id").alias("b"),
        F.col("n").alias("n_b"),
    )
    return a.join(b, on).where("id_a < id_b").groupBy("a", "b").agg(
        F.sum(F.col("n_a") * F.col("n_b")).alias("times")
    )


def _by_chunks(lines: DataFrame, chunk: int) -> DataFrame:
    """Pairs of the given lines: (a, b, times).

    The products of each order are cut into ceil(products / chunk) parts by a hash, and each part meets the whole order under
    a key of its own; most orders have one part. Pairs are counted map-side before they move.
    """
    sizes = lines.groupBy("order_id").agg(
        F.ceil(F.count("*") / chunk).cast("int").alias("parts")
    )
    parted = lines.join(sizes, "order_id")
    own_part = F.pmod(F.xxhash64("product_id"), F.col("parts")).cast("int")
    return _count_pairs(
        parted.withColumn("part", own_part),
        parted.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))),
        ["order_id", "part"],
    )


def name_bounds(lines: DataFrame) -> DataFrame:
    """(name_id, bound): no pair with the name can be bought together more often than this.

    In an order a pair counts copies of one name times copies of the other, and the other has at most as many as
    the order's most frequent product name.
    """
    per_order = lines.groupBy("order_id", "name_id").agg(F.sum("n").alias("copies"))
    most = per_order.groupBy("order_id").agg(F.max("copies").alias("most"))
    return per_order.join(most, "order_id").groupBy("name_id").agg(F.sum(F.col("copies") * F.col("most")).alias("bound"))


def candidate_lines(lines: DataFrame, n: int, chunk: int, seeds: int) -> DataFrame:
    """Lines whose names can be in one of the ``n`` top pairs.

    The ``seeds`` names of the greatest bounds are paired first. Their n-th count is a floor that the n-th count of all pairs
    reaches too, so names with a bound under it are in none of the top pairs. With fewer than n pairs among the seeds nothing is left out.
    """
    bounds = name_bounds(lines)
    strongest = bounds.orderBy(F.desc("bound"), "name_id").limit(seeds).select("name_id")
    counts = _by_chunks(lines.join(strongest, "name_id", "left_semi"), chunk).orderBy(F.desc("times")).limit(n)
    floor = counts.agg(F.when(F.count("*") >= n, F.min("times")).otherwise(0)).scalar()
    return lines.join(bounds.where(F.col("bound") >= floor).select("name_id"), "name_id", "left_semi")


def top_pairs(star: Star, n: int = 30, chunk: int = CHUNK, seeds: int = SEEDS) -> DataFrame:
    """The n pairs most often bought together; copies in one order multiply.

    Exact: pairs are formed among names whose bound reaches the n-th count of the strongest names' pairs, the same rule
    for all orders. Ties go by the lowest product ids of the two names.
    """
    lines, names = _folded_lines(star)
    pairs = _by_chunks(candidate_lines(lines, n, chunk, seeds), chunk)
    a = names.select(
        F.col("name_id").alias("a"), F.col("product_name").alias("product_a"),
        F.col("category").alias("category_a"),
    )
    b = names.select(
        F.col("name_id").alias("b"), F.col("product_name").alias("product_b"),
        F.col("category").alias("category_b"),
    )
    return (
        top_n(pairs, n, "times", ["a", "b"]).join(a, "a").join(b, "b")
        .orderBy(F.desc("times"), "a", "b")
        .select(
            "product_a", "product_b", "category_a", "category_b",
            F.col("times").alias("times_bought_together"),
        )
    )
