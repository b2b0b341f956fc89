"""Table schemas, fixed domain values and tunable parameters of the retail star."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field

MONEY = "decimal(18,2)"
SHARE = "decimal(5,4)"

# Clean tables, as DDL (primary keys: first column; products.sku is unique too).
CLEAN_SCHEMAS = {
    "customers": f"""customer_id BIGINT, first_name STRING, last_name STRING, email STRING,
        phone STRING, gender STRING, date_of_birth DATE, registration_date DATE, city STRING,
        state STRING, country STRING, postal_code STRING, loyalty_tier STRING,
        preferred_channel STRING""",
    "products": f"""product_id BIGINT, sku STRING, product_name STRING, category STRING,
        sub_category STRING, brand STRING, unit_cost {MONEY}, unit_price {MONEY},
        supplier_id INT, is_active INT, launch_date DATE, weight_kg DOUBLE,
        stock_quantity INT, margin_flag INT""",
    "orders": f"""order_id BIGINT, customer_id BIGINT, order_date DATE, ship_date DATE,
        delivery_date DATE, channel STRING, payment_method STRING, shipping_cost {MONEY},
        discount_amount {MONEY}, status STRING, city STRING, state STRING, country STRING,
        order_year INT, order_month STRING, order_dow STRING, orphaned_order INT""",
    "order_items": f"""item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT,
        unit_price {MONEY}, discount_pct {SHARE}, line_total {MONEY}""",
    "returns": f"""return_id BIGINT, order_id BIGINT, product_id BIGINT, return_date DATE,
        reason STRING, refund_amount {MONEY}, status STRING""",
}

CLEAN_COLUMNS = {
    table: [column.split()[0] for column in re.split(r",\s+", ddl)]
    for table, ddl in CLEAN_SCHEMAS.items()
}

# Columns that name a row of another table, by its primary key.
FOREIGN_KEYS = {
    "customers": {},
    "products": {},
    "orders": {"customer_id": "customers"},
    "order_items": {"order_id": "orders", "product_id": "products"},
    "returns": {"order_id": "orders", "product_id": "products"},
}

# Raw files are read as text; the cleaning rules give every column its type.
RAW_COLUMNS = {
    "customers": [
        "customer_id", "first_name", "last_name", "email", "phone", "gender", "date_of_birth",
        "registration_date", "city", "state", "country", "postal_code", "loyalty_tier",
        "preferred_channel",
    ],
    "products": [
        "product_id", "sku", "product_name", "category", "sub_category", "brand", "unit_cost",
        "unit_price", "supplier_id", "is_active", "launch_date", "weight_kg", "stock_quantity",
    ],
    "orders": [
        "order_id", "customer_id", "order_date", "ship_date", "delivery_date", "channel",
        "payment_method", "shipping_cost", "discount_amount", "status", "city", "state",
        "country",
    ],
    "order_items": [
        "item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct",
        "line_total",
    ],
    "returns": [
        "return_id", "order_id", "product_id", "return_date", "reason", "refund_amount",
        "status",
    ],
}


def raw_schema(table: str) -> str:
    return ", ".join(f"{name} STRING" for name in RAW_COLUMNS[table])


# They decide results, so they are stated as they are.
REVENUE_STATUSES = ("Completed", "Shipped")
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
TIER_SPELLINGS = {
    "GOLD": "Gold", "SILVER": "Silver", "BRONZE": "Bronze", "PLATINUM": "Platinum",
    "gold": "Gold", "silver": "Silver", "bronze": "Bronze", "platinum": "Platinum",
    "Bronz": "Bronze", "Platinium": "Platinum",
}
CUSTOMER_COUNTRIES = {"USA": "US", "us": "US", "United States": "US", "U.S.": "US"}
ORDER_COUNTRIES = {"USA": "US", "us": "US", "United States": "US"}
ISO_DATE = ("yyyy-MM-dd",)
# Every layout that the raw files are known to use.
KNOWN_DATES = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy.MM.dd", "MM-dd-yyyy", "dd MMM yyyy")
WEEKDAY_LABELS = (
    "1-Monday", "2-Tuesday", "3-Wednesday", "4-Thursday", "5-Friday", "6-Saturday", "7-Sunday",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
CLV_LABELS = ("VIP", "High Value", "Mid Value", "Low Value")
DISCOUNT_LABELS = ("0% (no discount)", "1-10%", "11-20%", "21-30%", "31%+")
FREQUENCY_LABELS = (
    "1 order (one-time)", "2-3 orders", "4-6 orders", "7-10 orders", "10+ orders (loyal)",
)
CHURN_LABELS = ("Churned", "At Risk", "Active")
ABC_LABELS = ("A", "B", "C")


@dataclass(frozen=True)
class Params:
    """Report parameters; the defaults are the published ones, callers override per data set."""

    revenue_statuses: tuple[str, ...] = REVENUE_STATUSES
    as_of: dt.date = dt.date(2024, 12, 31)
    clv_cuts: tuple[float, ...] = (500000, 100000, 20000)
    churn_days: tuple[int, int] = (180, 90)
    discount_cuts: tuple[str, ...] = ("0", "0.10", "0.20", "0.30")
    frequency_cuts: tuple[int, ...] = (1, 3, 6, 10)
    cohort_months: int = 12
    cohort_min_size: int = 20
    monthly_target: float = 13000000
    abc_cuts: tuple[float, float] = (0.80, 0.95)
    active_days: int = 90
    active_since: dt.date = dt.date(2024, 10, 1)
    latest_year: int = 2024
    growth_years: tuple[int, int] = (2022, 2023)
