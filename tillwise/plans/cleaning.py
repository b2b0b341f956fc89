"""Cleaning of the five raw tables, in rule order, with counts for the quality report.

``stage_*`` returns the clean rows plus ``_dq_…`` counts; ``clean_*`` drops the counts. Later
tables lean on earlier ones: items and returns on clean products, the last pass on orders.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions import (
    clip_fill, digits_only, line_total, money, null_outside, parse_date, parse_money,
    repair_email, standardise, title_case, trim_upper, try_int,
)
from tillwise.operators.integrity import fk_report
from tillwise.operators.quality import (
    MARK, abs_values, add_date_parts, cap_outliers, dedup_by_key, drop_exact_duplicates,
    fill_constant, flag, impute_group_median, null_when, quality_report,
    without_marks,
)
from tillwise.schema import (
    CLEAN_COLUMNS, CUSTOMER_COUNTRIES, ISO_DATE, LOYALTY_TIERS, MONEY, ORDER_COUNTRIES, SHARE, TIER_SPELLINGS,
)

DUPLICATES = MARK + "exact_duplicates"


@dataclass(frozen=True)
class CleaningRules:
    """Choices with a strict default: what the published results were made with.

    ``KNOWN_DATES`` reads every known date layout, ``loose_email`` repairs addresses without
    word breaks, ``null_email="keep"`` keeps all customers that have no address.
    """

    dates: tuple[str, ...] = ISO_DATE
    loose_email: bool = False
    null_email: str = "collapse"
    letter_runs: bool = True


def _mark(condition: Column) -> Column:
    return F.coalesce(condition.cast("bigint"), F.lit(0).cast("bigint"))


def stage_customers(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    df = drop_exact_duplicates(raw, DUPLICATES, by_hash=False)
    df = df.withColumns({
        "customer_id": try_int("customer_id"),
        "first_name": title_case("first_name", rules.letter_runs),
        "last_name": title_case("last_name", rules.letter_runs),
        "email": repair_email("email", rules.loose_email),
    })
    df = df.withColumn(MARK + "email_invalid", _mark(F.col("email").isNull()))
    df = dedup_by_key(
        df, "email", "customer_id", null_key=rules.null_email, mark=MARK + "email_duplicates"
    )
    df = df.withColumns({
        "country": F.trim(standardise("country", CUSTOMER_COUNTRIES)),
        "loyalty_tier": null_outside(
            standardise("loyalty_tier", TIER_SPELLINGS), LOYALTY_TIERS
        ),
        "registration_date": parse_date("registration_date", rules.dates),
        "date_of_birth": parse_date("date_of_birth", rules.dates),
        "phone": digits_only("phone"),
        "state": trim_upper("state"),
        "postal_code": F.trim("postal_code"),
    })
    return df.withColumns({
        MARK + "loyalty_tier_unrecognised": _mark(F.col("loyalty_tier").isNull()),
        MARK + "registration_date_unreadable": _mark(F.col("registration_date").isNull()),
    })


def stage_products(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    df = drop_exact_duplicates(raw, DUPLICATES, by_hash=False)
    df = df.withColumns({
        "product_id": try_int("product_id"),
        "product_name": title_case("product_name", rules.letter_runs),
        "unit_price": parse_money("unit_price"),
        "unit_cost": F.col("unit_cost").try_cast(MONEY),
        "supplier_id": try_int("supplier_id", "int"),
        "is_active": try_int("is_active", "int"),
        "launch_date": parse_date("launch_date", rules.dates),
        "weight_kg": F.col("weight_kg").try_cast("double"),
        "stock_quantity": try_int("stock_quantity", "int"),
    })
    df = cap_outliers(df, "unit_price", "iqr", MARK + "price_capped")
    df = flag(df, "margin_flag", F.col("unit_price") < F.col("unit_cost"))
    df = df.withColumns({
        MARK + "price_below_cost": F.col("margin_flag").cast("bigint"),
        MARK + "stock_negative": _mark(F.col("stock_quantity") < 0),
    })
    df = abs_values(df, ["stock_quantity"])
    return impute_group_median(df, "weight_kg", "category")


def stage_orders(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    df = drop_exact_duplicates(raw, DUPLICATES, by_hash=False)
    dates = ("order_date", "ship_date", "delivery_date")
    df = df.withColumns({
        "order_id": try_int("order_id"),
        "customer_id": try_int("customer_id"),
        **{c: parse_date(c, rules.dates) for c in dates},
        "shipping_cost": F.coalesce(
            F.col("shipping_cost").try_cast(MONEY), F.lit(0).cast(MONEY)
        ),
        "discount_amount": F.col("discount_amount").try_cast(MONEY),
        "country": F.trim(standardise("country", ORDER_COUNTRIES)),
    })
    too_early = F.col("ship_date") < F.col("order_date")
    df = df.withColumns({
        MARK + "order_date_unreadable": _mark(F.col("order_date").isNull()),
        MARK + "shipped_before_ordered": _mark(too_early),
    })
    df = null_when(df, ["ship_date", "delivery_date"], too_early)
    df = cap_outliers(df, "shipping_cost", "iqr_or_z", MARK + "shipping_capped")
    df = flag(df, "orphaned_order", F.col("customer_id").isNull())
    df = df.withColumn(MARK + "customer_missing", F.col("orphaned_order").cast("bigint"))
    return add_date_parts(df, "order_date")


def _mark_orphans(
    df: DataFrame, products: DataFrame, orders: DataFrame, *product_cols: str
) -> DataFrame:
    """Count lines without a product, and of the others those without an order.

    Products are unique on their key and order keys are made so, hence the left joins keep
    every row once. The wanted product columns come along under ``_product_<name>``.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    known_products = products.select(
        "product_id", zero.alias("_no_product"),
        *[F.col(c).alias(f"_product_{c}") for c in product_cols],
    )
    known_orders = orders.select("order_id").distinct().withColumn("_no_order", zero)
    marked = df.join(known_products, "product_id", "left").join(known_orders, "order_id", "left")
    no_product = F.coalesce("_no_product", one)
    return marked.withColumns({
        MARK + "product_orphans": no_product,
        MARK + "order_orphans": F.when(no_product == 0, F.coalesce("_no_order", one)).otherwise(
            zero
        ),
    }).drop("_no_product", "_no_order")


def stage_order_items(
    raw: DataFrame, products: DataFrame, orders: DataFrame,
    rules: CleaningRules = CleaningRules(),
) -> DataFrame:
    """Staged lines still hold the orphans, counted; ``clean_order_items`` drops them."""
    df = drop_exact_duplicates(raw, DUPLICATES, by_hash=False)
    df = df.withColumns({
        "item_id": try_int("item_id"),
        "order_id": try_int("order_id"),
        "product_id": try_int("product_id"),
        "quantity": try_int("quantity", "int"),
        "unit_price": F.col("unit_price").try_cast(MONEY),
        "discount_pct": clip_fill(F.col("discount_pct").try_cast("double"), 0.0, 1.0, 0.0)
        .cast(SHARE),
    })
    df = df.withColumn(MARK + "quantity_negative", _mark(F.col("quantity") < 0))
    df = abs_values(df, ["quantity"], zero_to=1)
    # One join brings both the list price for missing prices and the orphan mark.
    df = _mark_orphans(df, products, orders, "unit_price")
    df = df.withColumn("unit_price", F.coalesce("unit_price", "_product_unit_price"))
    df = df.drop("_product_unit_price")
    df = df.withColumn(MARK + "price_still_missing", _mark(F.col("unit_price").isNull()))
    return df.withColumn("line_total", line_total("quantity", "unit_price", "discount_pct"))


def stage_returns(
    raw: DataFrame, products: DataFrame, orders: DataFrame,
    rules: CleaningRules = CleaningRules(),
) -> DataFrame:
    df = drop_exact_duplicates(raw, DUPLICATES, by_hash=False)
    df = df.withColumns({
        "return_id": try_int("return_id"),
        "order_id": try_int("order_id"),
        "product_id": try_int("product_id"),
        "return_date": parse_date("return_date", rules.dates),
        "refund_amount": F.col("refund_amount").try_cast(MONEY),
    })
    df = df.withColumn(MARK + "return_date_unreadable", _mark(F.col("return_date").isNull()))
    df = cap_outliers(df, "refund_amount", "iqr", MARK + "refund_capped")
    df = fill_constant(df, {"reason": "Unknown"})
    return _mark_orphans(df, products, orders)


def _finish(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in their declared order."""
    return without_marks(df).select(*CLEAN_COLUMNS[table])


def _without_orphans(df: DataFrame) -> DataFrame:
    kept = (F.col(MARK + "product_orphans") == 0) & (F.col(MARK + "order_orphans") == 0)
    return df.where(kept)


def clean_customers(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _finish(stage_customers(raw, rules), "customers")


def clean_products(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _finish(stage_products(raw, rules), "products")


def clean_orders(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _finish(stage_orders(raw, rules), "orders")


def clean_order_items(
    raw: DataFrame, products: DataFrame, orders: DataFrame,
    rules: CleaningRules = CleaningRules(),
) -> DataFrame:
    staged = stage_order_items(raw, products, orders, rules)
    return _finish(_without_orphans(staged), "order_items")


def clean_returns(
    raw: DataFrame, products: DataFrame, orders: DataFrame,
    rules: CleaningRules = CleaningRules(),
) -> DataFrame:
    staged = stage_returns(raw, products, orders, rules)
    return _finish(_without_orphans(staged), "returns")


def order_keys(raw: DataFrame) -> DataFrame:
    """Keys of the clean orders. Cleaning drops no order, so the raw keys do."""
    return raw.select(try_int("order_id").alias("order_id")).distinct()


def clean_all(
    raw: Mapping[str, DataFrame], rules: CleaningRules = CleaningRules()
) -> dict[str, DataFrame]:
    """The five clean tables.

    Items and returns need the clean products, a dimension, and no more of the orders than their
    keys. All stays lazy.
    """
    products = clean_products(raw["products"], rules)
    keys = order_keys(raw["orders"])
    return {
        "customers": clean_customers(raw["customers"], rules),
        "products": products,
        "orders": clean_orders(raw["orders"], rules),
        "order_items": clean_order_items(raw["order_items"], products, keys, rules),
        "returns": clean_returns(raw["returns"], products, keys, rules),
    }


def quality_log(
    raw: Mapping[str, DataFrame], rules: CleaningRules = CleaningRules()
) -> DataFrame:
    """(table_name, rule, affected): one aggregation per staged table."""
    staged_products = stage_products(raw["products"], rules)
    products = _finish(staged_products, "products")
    keys = order_keys(raw["orders"])
    return quality_report({
        "customers": stage_customers(raw["customers"], rules),
        "products": staged_products,
        "orders": stage_orders(raw["orders"], rules),
        "order_items": stage_order_items(raw["order_items"], products, keys, rules),
        "returns": stage_returns(raw["returns"], products, keys, rules),
    })


def integrity_report(clean: Mapping[str, DataFrame]) -> DataFrame:
    """Orphan counts of the three foreign keys that the last cleaning pass checks."""
    return fk_report([
        ("orders", clean["orders"], "customers", clean["customers"], "customer_id"),
        ("order_items", clean["order_items"], "orders", clean["orders"], "order_id"),
        ("returns", clean["returns"], "orders", clean["orders"], "order_id"),
    ])
