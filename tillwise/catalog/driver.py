"""The retail star over the TPC-H-like parquet tables, read lazily with declared schemas."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.functions import line_total, money, round_half
from tillwise.operators.star import Star
from tillwise.schema import SHARE, Params
from tillwise.session import configure

# Declared, so that no job has to look into the files before a plan exists.
FILE_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}

DRIVER_PARAMS = Params(
    revenue_statuses=("F", "O"),
    as_of=dt.date(2001, 8, 1),
    clv_cuts=(2000000, 1500000, 1000000),
    discount_cuts=("0", "0.02", "0.05", "0.08"),
    monthly_target=25000000,
    active_since=dt.date(2001, 5, 1),
    latest_year=2001,
    growth_years=(1999, 2000),
)


class DriverStar(Star):
    """Star whose tables are read only when a query asks for them."""

    def __init__(self, spark: SparkSession, folder: str, params: Params = DRIVER_PARAMS):
        self.spark = configure(spark)
        self.folder = folder
        self.params = params

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(FILE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        lines = self.table("lineitem").select(
            F.col("l_linenumber").cast("bigint").alias("item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money(round_half(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0)))).alias("unit_price"),
            F.col("l_discount").cast(SHARE).alias("discount_pct"),
            money("l_extendedprice").alias("extended"),
            "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("l_shipdate"),
        )
        return lines.withColumn("line_total", line_total(F.lit(1), "extended", "discount_pct"))

    @cached_property
    def lines(self) -> DataFrame:
        """Cents straight from the DOUBLE columns, which hold exact cents: no decimals here."""
        bp = "CAST(floor(l_discount * 10000 + 0.5) AS BIGINT)"
        extended = "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"
        return self.table("lineitem").selectExpr(
            "CAST(l_linenumber AS BIGINT) AS item_id", "l_orderkey AS order_id",
            "l_partkey AS product_id", "CAST(l_quantity AS INT) AS quantity",
            f"CAST(l_discount AS {SHARE}) AS discount_pct",
            f"({extended} * (10000 - {bp}) + 5000) DIV 10000 AS amount",
            "CAST(floor(l_extendedprice / nullif(l_quantity, 0) * 100 + 0.5) AS BIGINT) AS price",
            "l_returnflag", "l_linestatus", "CAST(l_shipdate AS DATE) AS ship_date",
        )

    @cached_property
    def refunds(self) -> DataFrame:
        return self.lines.where("l_returnflag = 'R'").selectExpr(
            "order_id * 10 + item_id AS return_id", "order_id", "product_id",
            "ship_date AS return_date", "l_linestatus AS reason", "amount AS refund",
            "l_returnflag AS status",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._lines.select(
            "item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct",
            "line_total",
        )

    @cached_property
    def returns(self) -> DataFrame:
        return self._lines.where("l_returnflag = 'R'").select(
            (F.col("order_id") * 10 + F.col("item_id")).alias("return_id"),
            "order_id", "product_id", F.col("l_shipdate").alias("return_date"),
            F.col("l_linestatus").alias("reason"), F.col("line_total").alias("refund_amount"),
            F.col("l_returnflag").alias("status"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_orderpriority").alias("channel"), F.col("o_orderstatus").alias("status"),
        )

    @cached_property
    def orders_geo(self) -> DataFrame:
        """These orders carry no state of their own; it is the nation of their customer."""
        return self.orders.join(self.customers.select("customer_id", "state"), "customer_id")

    @cached_property
    def customers(self) -> DataFrame:
        parts = F.split("c_name", "#")
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("c_custkey").alias("customer_id"), parts[0].alias("first_name"),
            parts[1].alias("last_name"), F.col("c_mktsegment").alias("loyalty_tier"),
            F.col("n_name").alias("state"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_size").cast("string").alias("sub_category"),
            F.col("p_brand").alias("brand"),
            money(F.round(money("p_retailprice") * F.lit("0.6").cast("decimal(2,1)"), 2))
            .alias("unit_cost"),
            money("p_retailprice").alias("unit_price"),
        )
