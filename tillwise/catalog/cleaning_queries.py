"""Registered cleaning queries: each rule, and each whole cleaning, on the dirty raw tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.catalog.dirty import RAW, raw_frame
from tillwise.catalog.driver import DriverStar
from tillwise.functions import (
    clip_fill, digits_only, line_total, null_outside, parse_date, parse_money, repair_email,
    round_half, standardise, title_case, trim_upper, try_int,
)
from tillwise.operators import integrity, quality
from tillwise.operators.star import Star
from tillwise.plans import cleaning, measures, queries as Q
from tillwise.schema import (
    CUSTOMER_COUNTRIES, KNOWN_DATES, LOYALTY_TIERS, MONEY, ISO_DATE, SHARE, TIER_SPELLINGS,
)
from tillwise.sources.files import row_counts
from tillwise.sources.layout import store_star


def _raw(star: DriverStar) -> dict[str, DataFrame]:
    return {name: raw_frame(star, name) for name in RAW}


def doubles(df: DataFrame) -> DataFrame:
    """Decimals leave as DOUBLE."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in df.schema.fields
    ])


def d01(star: DriverStar) -> DataFrame:
    profiles = [quality.audit(df, name) for name, df in _raw(star).items()]
    return reduce(DataFrame.unionByName, profiles).withColumn(
        "null_pct", round_half("null_pct", 4)
    )


def d02(star: DriverStar) -> DataFrame:
    return quality.drop_exact_duplicates(raw_frame(star, "orders"))


def d02_documents(star: DriverStar) -> DataFrame:
    """Whole texts of the document table, exact copies dropped."""
    texts = star.table("documents").select("text", "lang", "source")
    return quality.drop_exact_duplicates(texts).groupBy("lang", "source").agg(
        F.count("*").alias("texts"), F.sum(F.length("text")).alias("characters")
    )


def d03(star: DriverStar) -> DataFrame:
    return raw_frame(star, "customers").select(
        "customer_id", title_case("first_name", parity=True).alias("first_name"),
        title_case("last_name", parity=True).alias("last_name"),
    )


def d04(star: DriverStar) -> DataFrame:
    return raw_frame(star, "customers").select(
        "customer_id", repair_email("email").alias("email"),
        repair_email("email", loose=True).alias("email_loose"),
    )


def _by_email(star: DriverStar, null_key: str) -> DataFrame:
    customers = quality.drop_exact_duplicates(raw_frame(star, "customers")).select(
        try_int("customer_id").alias("customer_id"), repair_email("email").alias("email")
    )
    return quality.dedup_by_key(customers, "email", "customer_id", null_key)


def d05_collapse(star: DriverStar) -> DataFrame:
    return _by_email(star, "collapse")


def d05_keep(star: DriverStar) -> DataFrame:
    return _by_email(star, "keep")


def d05_lines(star: DriverStar) -> DataFrame:
    """Lines repeat their (order, line number); the lowest product and then quantity stays."""
    lines = star.order_items.select("order_id", "item_id", "product_id", "quantity")
    return quality.dedup_by_key(lines, ["order_id", "item_id"], ["product_id", "quantity"])


def d06(star: DriverStar) -> DataFrame:
    return raw_frame(star, "customers").select(
        "customer_id", F.trim(standardise("country", CUSTOMER_COUNTRIES)).alias("country"),
        standardise("loyalty_tier", TIER_SPELLINGS).alias("loyalty_tier"),
    )


def d07(star: DriverStar) -> DataFrame:
    tier = null_outside(standardise("loyalty_tier", TIER_SPELLINGS), LOYALTY_TIERS)
    return raw_frame(star, "customers").groupBy(tier.alias("loyalty_tier")).agg(
        F.count("*").alias("customers")
    )


def d08(star: DriverStar) -> DataFrame:
    customers = raw_frame(star, "customers").select(
        F.concat(F.lit("c"), "customer_id").alias("row_key"), F.col("registration_date").alias("d")
    )
    orders = raw_frame(star, "orders").select(
        F.concat(F.lit("o"), "order_id").alias("row_key"), F.col("order_date").alias("d")
    )
    returns = raw_frame(star, "returns").select(
        F.concat(F.lit("r"), "return_id").alias("row_key"), F.col("return_date").alias("d")
    )
    return customers.unionByName(orders).unionByName(returns).select(
        "row_key", parse_date("d", ISO_DATE).alias("iso_only"),
        parse_date("d", KNOWN_DATES).alias("known_layouts"),
    )


def d09(star: DriverStar) -> DataFrame:
    return raw_frame(star, "customers").select("customer_id", digits_only("phone").alias("phone"))


def d10(star: DriverStar) -> DataFrame:
    return raw_frame(star, "customers").select(
        "customer_id", trim_upper("state").alias("state"), F.trim("postal_code").alias("postal_code")
    )


def d11(star: DriverStar) -> DataFrame:
    typed = quality.enforce_types(
        raw_frame(star, "orders").select("order_id", "customer_id", "shipping_cost"),
        {"order_id": "bigint", "customer_id": "bigint", "shipping_cost": "double"},
    )
    return typed


def d12(star: DriverStar) -> DataFrame:
    return raw_frame(star, "products").select(
        "product_id", parse_money("unit_price").cast("double").alias("unit_price"),
        F.col("unit_cost").try_cast(MONEY).cast("double").alias("unit_cost"),
    )


def _prices(star: DriverStar) -> DataFrame:
    raw = quality.drop_exact_duplicates(raw_frame(star, "products"))
    return raw.select(
        try_int("product_id").alias("product_id"), "category",
        parse_money("unit_price").alias("unit_price"),
    )


def _fences(df: DataFrame) -> DataFrame:
    return df.withColumns({c: round_half(c, 4) for c in ("q1", "q3", "lower", "upper")})


def d13(star: DriverStar) -> DataFrame:
    return _fences(quality.iqr_fences(_prices(star), "unit_price"))


def d13_by_category(star: DriverStar) -> DataFrame:
    return _fences(quality.iqr_fences(_prices(star), "unit_price", by=["category"]))


def d13_lines(star: DriverStar) -> DataFrame:
    return _fences(quality.iqr_fences(star.order_items, "line_total"))


def _shipping(star: DriverStar) -> DataFrame:
    cost = F.coalesce(F.col("shipping_cost").try_cast(MONEY), F.lit(0).cast(MONEY))
    return quality.drop_exact_duplicates(raw_frame(star, "orders")).select(
        try_int("order_id").alias("order_id"), cost.alias("shipping_cost")
    )


def d14(star: DriverStar) -> DataFrame:
    return doubles(quality.zscore_flag(_shipping(star), "shipping_cost"))


def d15_price(star: DriverStar) -> DataFrame:
    return doubles(quality.cap_outliers(_prices(star), "unit_price", mark="capped"))


def d15_shipping(star: DriverStar) -> DataFrame:
    return doubles(
        quality.cap_outliers(_shipping(star), "shipping_cost", "iqr_or_z", mark="capped")
    )


def d16(star: DriverStar) -> DataFrame:
    priced = raw_frame(star, "products").select(
        "product_id", parse_money("unit_price").alias("price"),
        F.col("unit_cost").try_cast(MONEY).alias("cost"),
    )
    return quality.flag(priced, "margin_flag", F.col("price") < F.col("cost")).select(
        "product_id", "margin_flag"
    )


def _quantities(star: DriverStar) -> DataFrame:
    return raw_frame(star, "order_items").select(try_int("quantity", "int").alias("quantity"))


def d17(star: DriverStar) -> DataFrame:
    fixed = quality.abs_values(_quantities(star), ["quantity"], zero_to=1)
    return fixed.groupBy("quantity").agg(F.count("*").alias("lines"))


def d18(star: DriverStar) -> DataFrame:
    weights = raw_frame(star, "products").select(
        "product_id", "category", F.col("weight_kg").try_cast("double").alias("weight_kg")
    )
    return quality.impute_group_median(weights, "weight_kg", "category")


def d19(star: DriverStar) -> DataFrame:
    """Lines shipped before they were ordered lose their ship date."""
    shipped = star.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.to_date("l_shipdate").alias("ship_date")
    ).join(star.orders.select("order_id", "order_date"), "order_id")
    return quality.null_when(
        shipped, ["ship_date"], F.col("ship_date") < F.col("order_date")
    )


def d20(star: DriverStar) -> DataFrame:
    reasons = raw_frame(star, "returns").select("return_id", "reason")
    return quality.fill_constant(reasons, {"reason": "Unknown"}).groupBy("reason").agg(
        F.count("*").alias("returns")
    )


def d21(star: DriverStar) -> DataFrame:
    orders = raw_frame(star, "orders").select("order_id", "customer_id")
    return quality.flag(orders, "orphaned_order", F.col("customer_id").isNull())


def d22(star: DriverStar) -> DataFrame:
    return quality.add_date_parts(star.orders.select("order_id", "order_date"))


def _line_prices(star: DriverStar) -> DataFrame:
    return raw_frame(star, "order_items").select(
        try_int("order_id").alias("order_id"), try_int("product_id").alias("product_id"),
        F.col("item_id"), F.col("unit_price").try_cast(MONEY).alias("unit_price"),
    )


def d23(star: DriverStar) -> DataFrame:
    return doubles(quality.impute_from_lookup(
        _line_prices(star), "unit_price", star.products, "product_id", "unit_price"
    ))


def d24(star: DriverStar) -> DataFrame:
    """Kept and rejected lines add up to all lines."""
    kept, rejected = integrity.split_orphans(_line_prices(star), star.products, "product_id")
    return row_counts({"kept": kept, "rejected": rejected})


def d25(star: DriverStar) -> DataFrame:
    return integrity.fk_report([
        ("orders", raw_frame(star, "orders").withColumn("customer_id", try_int("customer_id")),
         "customers", star.customers, "customer_id"),
        ("order_items", _line_prices(star), "orders", star.orders, "order_id"),
        ("returns", raw_frame(star, "returns").withColumn("order_id", try_int("order_id")),
         "orders", star.orders, "order_id"),
    ])


def _discount(star: DriverStar) -> Column:
    return clip_fill(F.col("discount_pct").try_cast("double"), 0.0, 1.0, 0.0).cast(SHARE)


def d26(star: DriverStar) -> DataFrame:
    return raw_frame(star, "order_items").groupBy(
        _discount(star).cast("double").alias("discount_pct")
    ).agg(F.count("*").alias("lines"))


def d27(star: DriverStar) -> DataFrame:
    lines = raw_frame(star, "order_items").select(
        "order_id", "item_id", F.abs(try_int("quantity", "int")).alias("quantity"),
        F.col("unit_price").try_cast(MONEY).alias("unit_price"), _discount(star).alias("disc"),
    )
    return lines.select(
        "order_id", "item_id",
        line_total("quantity", "unit_price", "disc").cast("double").alias("line_total"),
    )


def s03(star: DriverStar) -> DataFrame:
    """Verdicts on a batch of orders, against the third of the orders that is stored.

    Arithmetic on the key gives rows a changed channel, a second version, a copy, an unknown customer, none, or no key.
    """
    orders = star.orders
    stored = orders.where("order_id % 3 = 0")
    o = "order_id"
    batch = orders.withColumn("v", F.expr(f"explode(CASE WHEN {o} % 5 = 0 THEN array(0, 0) WHEN {o} % 7 = 0 THEN array(0, 1) ELSE array(0) END)")).selectExpr(
        f"CASE WHEN {o} % 17 <> 0 THEN {o} END AS order_id",
        f"CASE WHEN {o} % 11 = 0 THEN customer_id + 10000000 WHEN {o} % 13 <> 0 THEN customer_id END AS customer_id",
        "order_date", f"CASE WHEN {o} % 6 = 0 THEN 'changed' ELSE channel END AS channel",
        "CASE WHEN v = 1 THEN 'Z' ELSE status END AS status",
    )
    return integrity.screen_rows(batch, stored, "order_id", {"customer_id": star.customers.select("customer_id")})


def d28(star: DriverStar) -> DataFrame:
    """Dense numbers for the distinct lines."""
    keys = ["order_id", "item_id", "product_id", "quantity"]
    lines = star.order_items.select(*keys).distinct()
    return quality.dense_id(lines, keys, "line_id")


def d29(star: DriverStar) -> DataFrame:
    return cleaning.quality_log(_raw(star))


def d30_customers(star: DriverStar) -> DataFrame:
    return cleaning.clean_customers(raw_frame(star, "customers"))


def d30_products(star: DriverStar) -> DataFrame:
    return doubles(cleaning.clean_products(raw_frame(star, "products")))


def d30_orders(star: DriverStar) -> DataFrame:
    return doubles(cleaning.clean_orders(raw_frame(star, "orders")))


def _parents(star: DriverStar) -> tuple[DataFrame, DataFrame]:
    products = cleaning.clean_products(raw_frame(star, "products"))
    return products, cleaning.order_keys(raw_frame(star, "orders"))


def d30_order_items(star: DriverStar) -> DataFrame:
    return doubles(cleaning.clean_order_items(raw_frame(star, "order_items"), *_parents(star)))


def d30_returns(star: DriverStar) -> DataFrame:
    return doubles(cleaning.clean_returns(raw_frame(star, "returns"), *_parents(star)))


def _on_clean_star(build: Callable[[Star], DataFrame]) -> Callable[[DriverStar], DataFrame]:
    """A named query on a plain star of the cleaned tables, so that the library's own lines count."""
    return lambda star: build(Star(**cleaning.clean_all(_raw(star)), params=star.params))


def d30_integrity(star: DriverStar) -> DataFrame:
    return cleaning.integrity_report(cleaning.clean_all(_raw(star)))


def s06(star: DriverStar) -> DataFrame:
    return row_counts({
        "customers": star.customers, "products": star.products, "orders": star.orders,
        "order_items": star.order_items, "returns": star.returns,
    })


CLEANING = {
    "s06_row_counts": s06,
    "d01_audit": d01,
    "d02_drop_exact_duplicates": d02,
    "d02_drop_duplicate_texts": d02_documents,
    "d03_title_case": d03,
    "d04_email_repair": d04,
    "d05_dedup_by_email_collapse": d05_collapse,
    "d05_dedup_by_email_keep": d05_keep,
    "d05_dedup_lines": d05_lines,
    "d06_standardise": d06,
    "d07_domain_check": d07,
    "d08_parse_dates": d08,
    "d09_phone_digits": d09,
    "d10_trim_state_postal": d10,
    "d11_enforce_types": d11,
    "d12_parse_money": d12,
    "d13_iqr_fences": d13,
    "d13_iqr_fences_by_category": d13_by_category,
    "d13_iqr_fences_lines": d13_lines,
    "d14_zscore": d14,
    "d15_cap_prices": d15_price,
    "d15_cap_shipping": d15_shipping,
    "d16_margin_flag": d16,
    "d17_abs_quantity": d17,
    "d18_group_median": d18,
    "d19_ship_before_order": d19,
    "d20_fill_constant": d20,
    "d21_orphan_flag": d21,
    "d22_date_parts": d22,
    "d23_price_lookup": d23,
    "d24_split_orphans": d24,
    "d25_fk_report": d25,
    "d26_clip_discount": d26,
    "d27_line_total": d27,
    "s05_q07_on_clean_star": _on_clean_star(Q.q07),
    "s05_q12_on_clean_star": _on_clean_star(Q.q12),
    "s05_m05_on_clean_star": _on_clean_star(
        lambda star: measures.measures(star, ["total_discount"], ["channel"])),
    "d28_dense_id": d28,
    "s03_keyed_append": s03,
    "s02_q12_on_stored_layout": lambda star: Q.q12(store_star(star, star.spark, buckets=4)),
    "s02_q19_on_stored_layout": lambda star: Q.q19(store_star(star, star.spark, buckets=4)),
    "d29_quality_report": d29,
    "d30_clean_customers": d30_customers,
    "d30_clean_products": d30_products,
    "d30_clean_orders": d30_orders,
    "d30_clean_order_items": d30_order_items,
    "d30_clean_returns": d30_returns,
    "d30_integrity": d30_integrity,
}
