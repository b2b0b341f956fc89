"""Raw, dirty tables made from the driver tables, for the cleaning queries.

Every row of the source table is kept; fixed arithmetic on its key decides which defect it
gets, and some rows come twice. The same text runs in Spark and, for the check, in DuckDB; the
two differ only in how they format and add dates and repeat rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tillwise.catalog.driver import DriverStar


@dataclass(frozen=True)
class Dialect:
    """The few functions that the two engines spell differently."""

    name: str

    def day(self, base: str, offset: str) -> str:
        if self.name == "spark":
            return f"date_add(DATE '{base}', CAST({offset} AS INT))"
        return f"(DATE '{base}' + CAST({offset} AS INT))"

    def shift(self, date: str, offset: str) -> str:
        if self.name == "spark":
            return f"date_add({date}, CAST({offset} AS INT))"
        return f"({date} + CAST({offset} AS INT))"

    def text(self, date: str, layout: str) -> str:
        if self.name == "spark":
            return f"date_format({date}, '{layout}')"
        for spark, duck in (("yyyy", "%Y"), ("MMM", "%b"), ("MM", "%m"), ("dd", "%d")):
            layout = layout.replace(spark, duck)
        return f"strftime({date}, '{layout}')"

    def copies(self, times: str) -> str:
        """A select item that repeats the row ``times`` times."""
        if self.name == "spark":
            return f"explode(sequence(1, {times})) AS copy_no"
        return f"unnest(range(1, 1 + {times})) AS copy_no"

    def key(self, number: str) -> str:
        return f"CAST({number} AS {'STRING' if self.name == 'spark' else 'VARCHAR'})"


SPARK = Dialect("spark")
DUCK = Dialect("duck")


def _case(*branches: tuple[str, str], rest: str) -> str:
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE {rest} END"


def raw_customers(d: Dialect) -> RawTable:
    k = "c_custkey"
    joined = d.day("1995-01-01", f"{k} % 2000")
    email = _case(
        (f"{k} % 61 = 0", f"'user' || {d.key(k)} || 'ATmailDOTcom'"),
        (f"{k} % 59 = 0", f"'User' || {d.key(k)} || '@mail DOT com'"),
        (f"{k} % 47 = 0", "NULL"),
        (f"{k} % 43 = 0", "'no-at-sign'"),
        (f"{k} % 50 = 1", f"'user' || {d.key(f'{k} - 1')} || '@mail.com'"),
        rest=f"'user' || {d.key(k)} || '@mail.com '",
    )
    columns = {
        "customer_id": d.key(k),
        "first_name": _case(
            (f"{k} % 10 = 0", "'JOHN'"), (f"{k} % 10 = 1", "'o''neil'"),
            (f"{k} % 10 = 2", "' anne-marie '"), rest="c_name"),
        "last_name": _case((f"{k} % 10 = 3", "lower(c_mktsegment)"), rest="c_mktsegment"),
        "email": email,
        "phone": _case(
            (f"{k} % 20 = 0", "NULL"), (f"{k} % 37 = 0", "'555-12'"),
            rest=f"'(555) 123-' || {d.key(f'1000 + {k} % 9000')} || 'x89'"),
        "gender": _case((f"{k} % 50 = 0", "NULL"), (f"{k} % 2 = 0", "'Female'"), rest="'Male'"),
        "date_of_birth": _case(
            (f"{k} % 33 = 0", "NULL"),
            rest=d.text(d.day("1950-01-01", f"{k} % 15000"), "yyyy-MM-dd")),
        "registration_date": _case(
            (f"{k} % 50 = 7", d.text(joined, "MM/dd/yyyy")),
            (f"{k} % 50 = 8", d.text(joined, "yyyy.MM.dd")),
            (f"{k} % 50 = 9", "'12-/4/98-'"), rest=d.text(joined, "yyyy-MM-dd")),
        "city": "n_name",
        "state": "' ' || lower(n_name) || ' '",
        "country": _case(
            (f"{k} % 20 = 0", "'USA'"), (f"{k} % 20 = 1", "'us'"),
            (f"{k} % 20 = 2", "'United States'"), (f"{k} % 20 = 3", "'U.S.'"),
            (f"{k} % 20 = 4", "' US '"), rest="'US'"),
        "postal_code": f"' ' || lpad({d.key(f'{k} % 100000')}, 5, '0')",
        "loyalty_tier": _case(
            (f"{k} % 11 = 0", "'GOLD'"), (f"{k} % 11 = 1", "'silver'"),
            (f"{k} % 11 = 2", "'Bronz'"), (f"{k} % 11 = 3", "'Platinium'"),
            (f"{k} % 11 = 4", "'Diamond'"), (f"{k} % 11 = 5", "NULL"), rest="'Bronze'"),
        "preferred_channel": _case((f"{k} % 25 = 0", "NULL"), rest="c_mktsegment"),
    }
    return RawTable(columns, f"CASE WHEN {k} % 101 = 0 THEN 2 ELSE 1 END", "customer")


def raw_products(d: Dialect) -> RawTable:
    k = "p_partkey"
    cents = "CAST(p_retailprice AS DECIMAL(18,2))"
    price = d.key(cents)
    columns = {
        "product_id": d.key(k),
        "sku": f"'SKU-' || lpad({d.key(k)}, 9, '0')",
        "product_name": _case(
            (f"{k} % 12 = 0", "upper(p_name)"), (f"{k} % 12 = 1", "p_name || ' men''s '"),
            (f"{k} % 12 = 2", "'non-' || p_name"), rest="p_name"),
        "category": "p_type",
        "sub_category": d.key("p_size"),
        "brand": "p_brand",
        "unit_cost": _case(
            (f"{k} % 89 = 0", d.key(f"{cents} * 2")), rest=price),
        "unit_price": _case(
            (f"{k} % 40 = 3", f"'$' || {price}"), (f"{k} % 40 = 4", f"{price} || ' USD'"),
            (f"{k} % 97 = 5", "''"), (f"{k} % 97 = 6", "'abc'"),
            (f"{k} % 41 = 7", d.key(f"{cents} * 100")),
            rest=d.key(f"{cents} + {k} % 700")),
        "supplier_id": _case((f"{k} % 25 = 0", "NULL"), rest=d.key(f"{k} % 100")),
        "is_active": _case((f"{k} % 10 = 0", "'0'"), rest="'1'"),
        "launch_date": _case(
            (f"{k} % 71 = 0", "'soon'"),
            rest=d.text(d.day("1994-01-01", f"{k} % 900"), "yyyy-MM-dd")),
        "weight_kg": _case(
            (f"{k} % 19 = 0", "NULL"), rest=d.key("CAST(p_size AS INT)")),
        "stock_quantity": _case(
            (f"{k} % 31 = 0", f"'-' || {d.key(f'1 + {k} % 50')}"), rest=d.key(f"{k} % 500")),
    }
    return RawTable(columns, f"CASE WHEN {k} % 51 = 0 THEN 2 ELSE 1 END", "part")


def raw_orders(d: Dialect) -> RawTable:
    k = "o_orderkey"
    ordered = "CAST(o_orderdate AS DATE)"
    columns = {
        "order_id": d.key(k),
        "customer_id": _case(
            (f"{k} % 197 = 0", "NULL"), (f"{k} % 199 = 1", d.key("o_custkey + 1000000000")),
            rest=d.key("o_custkey")),
        "order_date": _case(
            (f"{k} % 67 = 0", d.text(ordered, "MM-dd-yyyy")),
            rest=d.text(ordered, "yyyy-MM-dd")),
        "ship_date": _case(
            (f"{k} % 9 = 0", "NULL"),
            (f"{k} % 101 = 2", d.text(d.shift(ordered, "-3"), "yyyy-MM-dd")),
            rest=d.text(d.shift(ordered, f"{k} % 5"), "yyyy-MM-dd")),
        "delivery_date": _case(
            (f"{k} % 5 = 0", "NULL"),
            rest=d.text(d.shift(ordered, f"5 + {k} % 7"), "yyyy-MM-dd")),
        "channel": "o_orderpriority",
        "payment_method": _case((f"{k} % 3 = 0", "'Card'"), rest="'Transfer'"),
        "shipping_cost": _case(
            (f"{k} % 331 = 0", "'5000'"), (f"{k} % 73 = 1", "NULL"), (f"{k} % 79 = 2", "'x'"),
            rest=d.key(f"CAST({k} % 30 AS DECIMAL(18,2)) + CAST(0.25 AS DECIMAL(18,2))")),
        "discount_amount": _case(
            (f"{k} % 4 = 0", d.key(f"CAST({k} % 20 AS DECIMAL(18,2))")), rest="'0.00'"),
        "status": "o_orderstatus",
        "city": "'City ' || " + d.key(f"{k} % 40"),
        "state": "'S' || " + d.key(f"{k} % 20"),
        "country": _case(
            (f"{k} % 20 = 0", "'USA'"), (f"{k} % 20 = 1", "'us'"),
            (f"{k} % 20 = 2", "'United States'"), (f"{k} % 20 = 3", "'U.S.'"), rest="' US'"),
    }
    return RawTable(columns, f"CASE WHEN {k} % 499 = 0 THEN 2 ELSE 1 END", "orders")


def raw_order_items(d: Dialect) -> RawTable:
    k = "l_orderkey * 7 + l_linenumber"
    price = "CAST(ROUND(l_extendedprice / l_quantity * 100) / 100 AS DECIMAL(18,2))"
    columns = {
        "item_id": d.key("l_linenumber"),
        "order_id": _case(
            (f"({k}) % 401 = 3", d.key("l_orderkey + 1000000000")), rest=d.key("l_orderkey")),
        "product_id": _case(
            (f"({k}) % 499 = 4", d.key("l_partkey + 1000000000")), rest=d.key("l_partkey")),
        "quantity": _case(
            (f"({k}) % 233 = 0", f"'-' || {d.key('CAST(l_quantity AS INT)')}"),
            (f"({k}) % 239 = 1", "'0'"), rest=d.key("CAST(l_quantity AS INT)")),
        "unit_price": _case((f"({k}) % 103 = 2", "NULL"), rest=d.key(price)),
        "discount_pct": _case(
            (f"({k}) % 307 = 5", "'-0.1'"), (f"({k}) % 311 = 6", "'1.4'"),
            (f"({k}) % 313 = 7", "NULL"), rest=d.key("CAST(l_discount AS DECIMAL(5,4))")),
        "line_total": d.key("CAST(l_extendedprice AS DECIMAL(18,2))"),
    }
    return RawTable(columns, f"CASE WHEN ({k}) % 997 = 0 THEN 2 ELSE 1 END", "lineitem")


def raw_returns(d: Dialect) -> RawTable:
    k = "l_orderkey * 7 + l_linenumber"
    shipped = "CAST(l_shipdate AS DATE)"
    refund = "CAST(l_extendedprice AS DECIMAL(18,2))"
    columns = {
        "return_id": d.key(k),
        "order_id": _case(
            (f"({k}) % 401 = 3", d.key("l_orderkey + 1000000000")), rest=d.key("l_orderkey")),
        "product_id": _case(
            (f"({k}) % 97 = 4", d.key("l_partkey + 1000000000")), rest=d.key("l_partkey")),
        "return_date": _case(
            (f"({k}) % 53 = 1", d.text(shipped, "dd MMM yyyy")),
            rest=d.text(shipped, "yyyy-MM-dd")),
        "reason": _case((f"({k}) % 16 = 0", "NULL"), rest="l_linestatus"),
        "refund_amount": _case(
            (f"({k}) % 307 = 0", d.key(f"{refund} * 100")), (f"({k}) % 409 = 1", "'n/a'"),
            rest=d.key(refund)),
        "status": "l_returnflag",
    }
    copies = f"CASE WHEN ({k}) % 101 = 0 THEN 2 ELSE 1 END"
    return RawTable(columns, copies, "lineitem", "l_returnflag = 'R'")


@dataclass(frozen=True)
class RawTable:
    """Column expressions, the number of copies of each row, and where the rows come from."""

    columns: dict[str, str]
    times: str
    table: str
    where: str = "true"

    def sql(self, d: Dialect) -> str:
        source = f"{self.table} JOIN nation ON c_nationkey = n_nationkey" if (
            self.table == "customer"
        ) else self.table
        items = ",\n  ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        return (
            f"SELECT {', '.join(self.columns)} FROM (SELECT {items},\n  {d.copies(self.times)}\n"
            f"FROM {source} WHERE {self.where}) raw"
        )


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "returns": raw_returns,
}


def raw_sql(name: str) -> str:
    return RAW[name](DUCK).sql(DUCK)


def raw_frame(star: DriverStar, name: str) -> DataFrame:
    spec = RAW[name](SPARK)
    source = star.table(spec.table)
    if spec.table == "customer":
        source = source.join(star.table("nation"), F.expr("c_nationkey = n_nationkey"))
    items = [f"{expr} AS {column}" for column, expr in spec.columns.items()]
    return source.where(spec.where).selectExpr(*items, SPARK.copies(spec.times)).select(
        *spec.columns
    )
