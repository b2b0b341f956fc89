"""The star and its joins: line-grain facts, order-grain rollups, slicers.

Two rules keep these joins whole at scale. Lines are added up per order (or per product)
before they meet the other side wherever the question allows it, so a heavy order or product
collapses on the map side. And no join carries a broadcast hint: Spark broadcasts a dimension
when its size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with
the skew join splitting heavy keys.
"""

from __future__ import annotations

import copy
import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F

from tillwise.functions import cents
from tillwise.schema import MONEY, Params


@dataclass
class Star:
    """The five clean tables plus report parameters."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    returns: DataFrame
    params: Params = field(default_factory=Params)

    @property
    def orders_geo(self) -> DataFrame:
        """Orders with their own ``state``; a source may override this to join it lazily."""
        return self.orders

    @property
    def lines(self) -> DataFrame:
        """Order lines with money in cents: ``amount`` (line total) and ``price``."""
        return self.order_items.select(
            "item_id", "order_id", "product_id", "quantity", "discount_pct",
            cents("line_total").alias("amount"), cents("unit_price").alias("price"),
        )

    @property
    def costs(self) -> DataFrame:
        """Products with their unit cost in cents, as ``cost``."""
        return self.products.withColumn("cost", cents("unit_cost")).drop("unit_cost")

    @property
    def refunds(self) -> DataFrame:
        """Returns with the refund in cents, as ``refund``."""
        return self.returns.withColumn("refund", cents("refund_amount")).drop("refund_amount")


def with_tables(star: Star, **tables: DataFrame) -> Star:
    """The same star with some tables replaced, for instance by a part of their rows."""
    other = copy.copy(star)
    if "orders" in tables:
        other.__dict__.pop("orders_geo", None)  # kept from the orders before
    other.__dict__.update(tables)
    return other


def revenue_orders(star: Star, *cols: str, geo: bool = False) -> DataFrame:
    """Orders that count as revenue, reduced to the columns a query needs."""
    orders = star.orders_geo if geo else star.orders
    return orders.where(F.col("status").isin(*star.params.revenue_statuses)).select(
        "order_id", *cols
    )


def order_totals(lines: DataFrame) -> DataFrame:
    """Lines added up per order: order_id is unique afterwards."""
    return lines.groupBy("order_id").agg(
        F.sum("amount").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count("amount").alias("lines"),
    )


def costed_lines(star: Star, *product_cols: str, how: str = "inner") -> DataFrame:
    """Order lines with ``line_cost``, ``line_profit`` and the wanted product columns."""
    products = star.costs.select("product_id", "cost", *product_cols)
    return with_profit(star.lines.join(products, "product_id", how))


def with_profit(lines: DataFrame) -> DataFrame:
    """Cost is quantity x unit cost; without a unit cost a line has no profit figure."""
    return lines.withColumn("line_cost", F.col("quantity") * F.col("cost")).withColumn(
        "line_profit", F.col("amount") - F.col("line_cost")
    )


def costed_order_totals(star: Star) -> DataFrame:
    """Per order, over lines with a known product: revenue, profit, discounts, line counts."""
    return costed_lines(star).groupBy("order_id").agg(
        F.sum("amount").alias("revenue"),
        F.sum("line_profit").alias("profit"),
        F.sum("discount_pct").alias("discounts"),
        F.count("amount").alias("lines"),
        F.count("discount_pct").alias("discount_lines"),
    )


def order_revenue(star: Star, *order_cols: str, geo: bool = False) -> DataFrame:
    """Revenue orders with their totals, one row per order (the order key is unique)."""
    return revenue_orders(star, *order_cols, geo=geo).join(
        order_totals(star.lines), "order_id"
    )


def revenue_lines(
    star: Star, *order_cols: str, products: DataFrame | None = None
) -> DataFrame:
    """Lines of revenue orders, with product columns where wanted.

    The product join comes first and the order join last, so that the result is spread by
    order_id when either is shuffled, and a following step per order needs no exchange.
    """
    lines = star.lines if products is None else star.lines.join(products, "product_id")
    return lines.join(revenue_orders(star, *order_cols), "order_id")


def build_fact(star: Star, how: str = "left") -> DataFrame:
    """Line-grain master fact: items, then orders, customers and products."""
    orders = star.orders_geo.withColumnRenamed("state", "state_order")
    customers = star.customers.select(
        "customer_id", "loyalty_tier", F.col("state").alias("state_cust")
    )
    products = star.products.select(
        "product_id", "product_name", "category", "sub_category", "brand", "unit_cost"
    )
    return (
        star.order_items.join(orders, "order_id", how)
        .join(customers, "customer_id", "left")
        .join(products, "product_id", "left")
    )


def revenue_fact(fact: DataFrame, statuses: Iterable[str]) -> DataFrame:
    """Revenue rows of the fact with gross profit; an unknown cost counts as 0."""
    cost = F.coalesce("unit_cost", F.lit(0).cast(MONEY))
    return (
        fact.where(F.col("status").isin(*statuses))
        .withColumn("unit_cost", cost)
        .withColumn(
            "gross_profit",
            (F.col("line_total") - F.col("quantity") * F.col("unit_cost")).cast(MONEY),
        )
    )


@dataclass(frozen=True)
class SliceSpec:
    """Report slicers; an unset slicer sets no condition."""

    years: tuple[int, ...] | None = None
    date_from: dt.date | None = None
    date_to: dt.date | None = None
    categories: tuple[str, ...] | None = None
    channels: tuple[str, ...] | None = None
    statuses: tuple[str, ...] | None = None
    states: tuple[str, ...] | None = None
    loyalty_tiers: tuple[str, ...] | None = None
    segments: tuple[str, ...] | None = None
    brands: tuple[str, ...] | None = None
    abc_classes: tuple[str, ...] | None = None


SLICER_COLUMNS = {
    "categories": "category", "channels": "channel", "statuses": "status", "states": "state",
    "loyalty_tiers": "loyalty_tier", "segments": "segment", "brands": "brand",
    "abc_classes": "abc_class",
}


def apply_slice(df: DataFrame, spec: SliceSpec | None) -> DataFrame:
    """Conjunction of the set slicers, applied before aggregation so that it reaches the scan."""
    if spec is None:
        return df
    # The folder of stored orders ('yyyy-MM'): its months are named too, so that others are not read.
    by_month = "order_month" in df.columns and df.schema["order_month"].dataType.typeName() == "string"
    if spec.years is not None:
        df = df.where(F.year("order_date").isin(*spec.years))
        if by_month:
            df = df.where(F.substring("order_month", 1, 4).isin(*[f"{y:04d}" for y in spec.years]))
    if spec.date_from is not None:
        df = df.where(F.col("order_date") >= F.lit(spec.date_from))
        if by_month:
            df = df.where(F.col("order_month") >= f"{spec.date_from:%Y-%m}")
    if spec.date_to is not None:
        df = df.where(F.col("order_date") <= F.lit(spec.date_to))
        if by_month:
            df = df.where(F.col("order_month") <= f"{spec.date_to:%Y-%m}")
    for slicer, column in SLICER_COLUMNS.items():
        wanted = getattr(spec, slicer)
        if wanted is not None:
            df = df.where(F.col(column).isin(*wanted))
    return df


# The report model's relationships, (many side, its column, one side, its column). A filter
# goes from the one side to the many side only.
RELATIONSHIPS = (
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "order_date", "dates", "date"),
    ("returns", "order_id", "orders", "order_id"),
    ("returns", "product_id", "products", "product_id"),
    ("segments", "customer_id", "customers", "customer_id"),
)

# Table of each column that can be sliced or grouped by.
TABLE_OF = {
    "product_id": "products", "product_name": "products", "category": "products", "sub_category": "products",
    "brand": "products", "abc_class": "products", "channel": "orders", "status": "orders", "state": "orders",
    "loyalty_tier": "customers", "segment": "segments", "year": "dates", "month": "dates",
}


def reached_from(table: str) -> set[str]:
    """Tables that a filter on ``table`` reaches along the relationships, itself included."""
    found, todo = set(), [table]
    while todo:
        here = todo.pop()
        if here not in found:
            found.add(here)
            todo += [many for many, _, one, _ in RELATIONSHIPS if one == here]
    return found


def reaches(column: str, fact: str) -> bool:
    return fact in reached_from(TABLE_OF[column])


def slice_reaching(spec: SliceSpec | None, fact: str) -> SliceSpec | None:
    """The slicers of ``spec`` that reach ``fact``; dates reach all facts."""
    if spec is None:
        return None
    lost = {slicer: None for slicer, column in SLICER_COLUMNS.items() if not reaches(column, fact)}
    return replace(spec, **lost)
