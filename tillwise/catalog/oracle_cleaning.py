"""DuckDB counterparts of the cleaning queries."""

from __future__ import annotations

from tillwise.catalog.dirty import raw_sql
from tillwise.catalog.oracle import big, dbl, named_queries, over, r2, rk
from tillwise.schema import RAW_COLUMNS

SHORT = {
    "customers": "raw_c", "products": "raw_p", "orders": "raw_o", "order_items": "raw_i",
    "returns": "raw_r",
}


def iso(column: str) -> str:
    return f"CAST(try_strptime(trim({column}), '%Y-%m-%d') AS DATE)"


def known(column: str) -> str:
    layouts = ["%Y-%m-%d", "%m/%d/%Y", "%Y.%m.%d", "%m-%d-%Y", "%d %b %Y"]
    tries = ", ".join(f"try_strptime(trim({column}), '{x}')" for x in layouts)
    return f"CAST(COALESCE({tries}) AS DATE)"


def title(column: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower(trim({column})), "
        "'([a-z]+|[^a-z]+)', 1), lambda y: upper(y[1]) || y[2:]), '')"
    )


def email(column: str, bound: str = "\\b") -> str:
    fixed = f"regexp_replace({column}, '{bound}AT{bound}', '@', 'g')"
    fixed = f"trim(lower(regexp_replace({fixed}, '{bound}DOT{bound}', '.', 'g')))"
    return f"CASE WHEN regexp_matches({fixed}, '^[^@]+@[^@]+\\.[^@]+$') THEN {fixed} END"


def number(column: str, kind: str = "BIGINT") -> str:
    return f"TRY_CAST({column} AS {kind})"


def price(column: str) -> str:
    return f"TRY_CAST(regexp_replace({column}, '[^0-9.]', '', 'g') AS DECIMAL(18,2))"


def cents(column: str) -> str:
    return f"TRY_CAST({column} AS DECIMAL(18,2))"


COUNTRY = ("CASE WHEN country IN ('USA', 'us', 'United States'{more}) THEN 'US' "
           "ELSE trim(country) END")
TIER = """CASE loyalty_tier WHEN 'GOLD' THEN 'Gold' WHEN 'gold' THEN 'Gold' WHEN 'SILVER' THEN 'Silver'
  WHEN 'silver' THEN 'Silver' WHEN 'BRONZE' THEN 'Bronze' WHEN 'bronze' THEN 'Bronze'
  WHEN 'Bronz' THEN 'Bronze' WHEN 'PLATINUM' THEN 'Platinum' WHEN 'platinum' THEN 'Platinum'
  WHEN 'Platinium' THEN 'Platinum' ELSE loyalty_tier END"""
KNOWN_TIER = f"CASE WHEN {TIER} IN ('Bronze', 'Silver', 'Gold', 'Platinum') THEN {TIER} END"
PHONE = ("CASE WHEN length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 7 "
         "THEN regexp_replace(phone, '[^0-9]', '', 'g') END")
DISCOUNT = ("CAST(COALESCE(CASE WHEN TRY_CAST(discount_pct AS DOUBLE) < 0 THEN 0.0 "
            "WHEN TRY_CAST(discount_pct AS DOUBLE) > 1 THEN 1.0 "
            "ELSE TRY_CAST(discount_pct AS DOUBLE) END, 0.0) AS DECIMAL(5,4))")


def fence(column: str) -> str:
    c = dbl(column)
    return (f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - "
            f"quantile_cont({c}, 0.25))")


def raw(*tables: str, body: str) -> str:
    parts = [f"{SHORT[t]} AS ({raw_sql(t)})" for t in tables]
    return "WITH " + ",\n".join(parts) + "\n" + body


# Clean tables, step by step; *_all still holds what later steps drop or count.
STEPS = {
    "c": f"""c_typed AS (
  SELECT {number('customer_id')} AS customer_id, {title('first_name')} AS first_name,
         {title('last_name')} AS last_name, {email('email')} AS email, {PHONE} AS phone, gender,
         {iso('date_of_birth')} AS date_of_birth, {iso('registration_date')} AS registration_date,
         city, upper(trim(state)) AS state, {COUNTRY.format(more=", 'U.S.'")} AS country,
         trim(postal_code) AS postal_code, {KNOWN_TIER} AS loyalty_tier, preferred_channel
  FROM (SELECT DISTINCT * FROM raw_c)),
clean_c AS (
  SELECT * FROM c_typed QUALIFY ROW_NUMBER() OVER (PARTITION BY email ORDER BY customer_id) = 1)""",
    "p": f"""p_typed AS (
  SELECT {number('product_id')} AS product_id, sku, {title('product_name')} AS product_name, category,
         sub_category, brand, {cents('unit_cost')} AS unit_cost, {price('unit_price')} AS unit_price,
         {number('supplier_id', 'INT')} AS supplier_id, {number('is_active', 'INT')} AS is_active,
         {iso('launch_date')} AS launch_date, TRY_CAST(weight_kg AS DOUBLE) AS weight_kg,
         {number('stock_quantity', 'INT')} AS stock_quantity
  FROM (SELECT DISTINCT * FROM raw_p)),
p_fence AS (SELECT {fence('unit_price')} AS hi FROM p_typed),
p_capped AS (
  SELECT * REPLACE (CASE WHEN unit_price > hi THEN CAST(hi AS DECIMAL(18,2)) ELSE unit_price END
                    AS unit_price), COALESCE(unit_price > hi, false) AS capped
  FROM p_typed, p_fence),
clean_p AS (
  SELECT * EXCLUDE (hi, capped) REPLACE (abs(stock_quantity) AS stock_quantity,
           COALESCE(weight_kg, quantile_cont(weight_kg, 0.5) OVER (PARTITION BY category)) AS weight_kg),
         CASE WHEN unit_price < unit_cost THEN 1 ELSE 0 END AS margin_flag
  FROM p_capped)""",
    "o": f"""o_typed AS (
  SELECT {number('order_id')} AS order_id, {number('customer_id')} AS customer_id,
         {iso('order_date')} AS order_date, {iso('ship_date')} AS ship_date,
         {iso('delivery_date')} AS delivery_date, channel, payment_method,
         COALESCE({cents('shipping_cost')}, 0) AS shipping_cost,
         {cents('discount_amount')} AS discount_amount, status, city, state,
         {COUNTRY.format(more="")} AS country
  FROM (SELECT DISTINCT * FROM raw_o)),
o_stats AS (
  SELECT {fence('shipping_cost')} AS hi, AVG({dbl('shipping_cost')}) AS mu,
         stddev_samp({dbl('shipping_cost')}) AS sigma FROM o_typed),
o_all AS (
  SELECT *, COALESCE(ship_date < order_date, false) AS early,
         shipping_cost > hi OR abs(shipping_cost - mu) / sigma > 3 AS far
  FROM o_typed, o_stats),
clean_o AS (
  SELECT * EXCLUDE (hi, mu, sigma, early, far)
         REPLACE (CASE WHEN NOT early THEN ship_date END AS ship_date,
                  CASE WHEN NOT early THEN delivery_date END AS delivery_date,
                  CASE WHEN far THEN CAST(hi AS DECIMAL(18,2)) ELSE shipping_cost END AS shipping_cost),
         CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END AS orphaned_order,
         CAST(year(order_date) AS INT) AS order_year, strftime(order_date, '%Y-%m') AS order_month,
         dayname(order_date) AS order_dow
  FROM o_all)""",
    "i": f"""i_typed AS (
  SELECT {number('item_id')} AS item_id, {number('order_id')} AS order_id,
         {number('product_id')} AS product_id, {number('quantity', 'INT')} AS raw_quantity,
         {cents('unit_price')} AS unit_price, {DISCOUNT} AS discount_pct
  FROM (SELECT DISTINCT * FROM raw_i)),
i_all AS (
  SELECT item_id, order_id, product_id, raw_quantity,
         CASE WHEN raw_quantity = 0 THEN 1 ELSE abs(raw_quantity) END AS quantity,
         COALESCE(i_typed.unit_price, clean_p.unit_price) AS unit_price, discount_pct,
         clean_p.product_id IS NULL AS no_product,
         order_id NOT IN (SELECT order_id FROM clean_o) AS no_order
  FROM i_typed LEFT JOIN clean_p USING (product_id)),
clean_i AS (
  SELECT item_id, order_id, product_id, quantity, unit_price, discount_pct,
         CAST(ROUND(quantity * unit_price * (1 - discount_pct), 2) AS DECIMAL(18,2)) AS line_total
  FROM i_all WHERE NOT no_product AND NOT no_order)""",
    "r": f"""r_typed AS (
  SELECT {number('return_id')} AS return_id, {number('order_id')} AS order_id,
         {number('product_id')} AS product_id, {iso('return_date')} AS return_date,
         COALESCE(reason, 'Unknown') AS reason, {cents('refund_amount')} AS refund_amount, status
  FROM (SELECT DISTINCT * FROM raw_r)),
r_all AS (
  SELECT *, COALESCE(refund_amount > hi, false) AS capped,
         product_id NOT IN (SELECT product_id FROM clean_p) AS no_product,
         order_id NOT IN (SELECT order_id FROM clean_o) AS no_order
  FROM r_typed, (SELECT {fence('refund_amount')} AS hi FROM r_typed)),
clean_r AS (
  SELECT return_id, order_id, product_id, return_date, reason,
         CASE WHEN capped THEN CAST(hi AS DECIMAL(18,2)) ELSE refund_amount END AS refund_amount, status
  FROM r_all WHERE NOT no_product AND NOT no_order)""",
}
TABLE_OF = {"c": "customers", "p": "products", "o": "orders", "i": "order_items", "r": "returns"}


def clean(keys: str, body: str) -> str:
    raws = [f"{SHORT[TABLE_OF[k]]} AS ({raw_sql(TABLE_OF[k])})" for k in keys]
    return "WITH " + ",\n".join(raws + [STEPS[k] for k in keys]) + "\n" + body


def _audit() -> str:
    rows = []
    for table, columns in RAW_COLUMNS.items():
        name = SHORT[table]
        for c in columns:
            rows.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count, "
                f"COUNT(*) - COUNT({c}) AS null_count, "
                f"{rk(f'(COUNT(*) - COUNT({c})) * 100.0::DOUBLE / COUNT(*)', 4)} AS null_pct, "
                f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {name})) AS duplicate_rows "
                f"FROM {name}"
            )
    return raw(*RAW_COLUMNS, body="\nUNION ALL ".join(rows))


def _quality() -> str:
    def copies(k: str) -> str:
        name = SHORT[TABLE_OF[k]]
        return (f"(SELECT COUNT(*) FROM {name}) - "
                f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {name}))")

    def of(table: str, condition: str) -> str:
        return f"(SELECT COUNT(*) FROM {table} WHERE {condition})"

    rules = [
        ("c", "exact_duplicates", copies("c")),
        ("c", "email_invalid", of("c_typed", "email IS NULL")),
        ("c", "email_duplicates", f"{of('c_typed', 'true')} - {of('clean_c', 'true')}"),
        ("c", "loyalty_tier_unrecognised", of("clean_c", "loyalty_tier IS NULL")),
        ("c", "registration_date_unreadable", of("clean_c", "registration_date IS NULL")),
        ("p", "exact_duplicates", copies("p")),
        ("p", "price_capped", of("p_capped", "capped")),
        ("p", "price_below_cost", of("clean_p", "margin_flag = 1")),
        ("p", "stock_negative", of("p_typed", "stock_quantity < 0")),
        ("o", "exact_duplicates", copies("o")),
        ("o", "order_date_unreadable", of("o_typed", "order_date IS NULL")),
        ("o", "shipped_before_ordered", of("o_all", "early")),
        ("o", "shipping_capped", of("o_all", "far")),
        ("o", "customer_missing", of("o_typed", "customer_id IS NULL")),
        ("i", "exact_duplicates", copies("i")),
        ("i", "quantity_negative", of("i_all", "raw_quantity < 0")),
        ("i", "price_still_missing", of("i_all", "unit_price IS NULL")),
        ("i", "product_orphans", of("i_all", "no_product")),
        ("i", "order_orphans", of("i_all", "no_order AND NOT no_product")),
        ("r", "exact_duplicates", copies("r")),
        ("r", "return_date_unreadable", of("r_typed", "return_date IS NULL")),
        ("r", "refund_capped", of("r_all", "capped")),
        ("r", "product_orphans", of("r_all", "no_product")),
        ("r", "order_orphans", of("r_all", "no_order AND NOT no_product")),
    ]
    rows = [
        f"SELECT '{TABLE_OF[k]}' AS table_name, '{rule}' AS rule, {big(sql)} AS affected"
        for k, rule, sql in rules
    ]
    return clean("cpoir", "\nUNION ALL ".join(rows))


def _fences(source: str, column: str, by: str = "") -> str:
    c = dbl(column)
    q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
    key = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {key}{rk('a', 4)} AS q1, {rk('b', 4)} AS q3, {rk('a - (b - a) * 1.5', 4)} AS lower, "
        f"{rk('b + (b - a) * 1.5', 4)} AS upper "
        f"FROM (SELECT {key}{q1} AS a, {q3} AS b FROM {source}{group})"
    )


P_PRICES = (f"prices AS (SELECT {number('product_id')} AS product_id, category, "
            f"{price('unit_price')} AS unit_price FROM (SELECT DISTINCT * FROM raw_p))")
O_SHIPPING = (f"shipping AS (SELECT {number('order_id')} AS order_id, "
              f"COALESCE({cents('shipping_cost')}, 0) AS shipping_cost "
              "FROM (SELECT DISTINCT * FROM raw_o))")
SHIP_STATS = (f"(SELECT {fence('shipping_cost')} AS hi, AVG({dbl('shipping_cost')}) AS mu, "
              f"stddev_samp({dbl('shipping_cost')}) AS sigma FROM shipping)")


def _doubles(table: str, *money: str) -> str:
    replaced = ", ".join(f"{dbl(m)} AS {m}" for m in money)
    return f"SELECT * REPLACE ({replaced}) FROM {table}"


def _on_clean(key: str) -> str:
    """SQL of a named query, with its flat rows taken from the cleaned tables."""
    flat = """, f AS (
  SELECT i.*, o.customer_id, o.order_date, o.channel, o.status, p.product_name, p.category, p.brand,
         p.unit_cost, i.line_total - i.quantity * p.unit_cost AS profit
  FROM clean_i i JOIN clean_o o USING (order_id) JOIN clean_p p USING (product_id)
  WHERE o.status IN ('F', 'O'))"""
    body = named_queries()[key].removeprefix(over("f", body="").rstrip())
    return clean("poi", flat + body)


def cleaning_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["s06_row_counts"] = over("ln", "pr", "cu", "od", "rt", body="""
SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM cu
UNION ALL SELECT 'products', COUNT(*) FROM pr UNION ALL SELECT 'orders', COUNT(*) FROM od
UNION ALL SELECT 'order_items', COUNT(*) FROM ln UNION ALL SELECT 'returns', COUNT(*) FROM rt""")
    q["d01_audit"] = _audit()
    q["d02_drop_exact_duplicates"] = raw("orders", body="SELECT DISTINCT * FROM raw_o")
    q["d02_drop_duplicate_texts"] = f"""
SELECT lang, source, COUNT(*) AS texts, {big('SUM(length(text))')} AS characters
FROM (SELECT DISTINCT text, lang, source FROM documents) GROUP BY ALL"""
    q["d03_title_case"] = raw("customers", body=f"""
SELECT customer_id, {title('first_name')} AS first_name, {title('last_name')} AS last_name FROM raw_c""")
    q["d04_email_repair"] = raw("customers", body=f"""
SELECT customer_id, {email('email')} AS email, {email('email', '')} AS email_loose FROM raw_c""")
    by_email = f"""
, m AS (SELECT DISTINCT {number('customer_id')} AS customer_id, {email('email')} AS email FROM raw_c)
SELECT customer_id, email FROM m
QUALIFY ROW_NUMBER() OVER (PARTITION BY email ORDER BY customer_id) = 1"""
    q["d05_dedup_by_email_collapse"] = raw("customers", body=by_email)
    q["d05_dedup_by_email_keep"] = raw("customers", body=by_email + " OR email IS NULL")
    q["d05_dedup_lines"] = over("ln", body="""
SELECT order_id, CAST(item_id AS BIGINT) AS item_id, product_id, quantity FROM ln
QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, item_id ORDER BY product_id, quantity) = 1""")
    q["d06_standardise"] = raw("customers", body=f"""
SELECT customer_id, {COUNTRY.format(more=", 'U.S.'")} AS country, {TIER} AS loyalty_tier FROM raw_c""")
    q["d07_domain_check"] = raw("customers", body=f"""
SELECT {KNOWN_TIER} AS loyalty_tier, COUNT(*) AS customers FROM raw_c GROUP BY 1""")
    q["d08_parse_dates"] = raw("customers", "orders", "returns", body=f"""
, d AS (SELECT 'c' || customer_id AS row_key, registration_date AS d FROM raw_c
  UNION ALL SELECT 'o' || order_id, order_date FROM raw_o
  UNION ALL SELECT 'r' || return_id, return_date FROM raw_r)
SELECT row_key, {iso('d')} AS iso_only, {known('d')} AS known_layouts FROM d""")
    q["d09_phone_digits"] = raw("customers", body=f"SELECT customer_id, {PHONE} AS phone FROM raw_c")
    q["d10_trim_state_postal"] = raw("customers", body="""
SELECT customer_id, upper(trim(state)) AS state, trim(postal_code) AS postal_code FROM raw_c""")
    q["d11_enforce_types"] = raw("orders", body=f"""
SELECT {number('order_id')} AS order_id, {number('customer_id')} AS customer_id,
       TRY_CAST(shipping_cost AS DOUBLE) AS shipping_cost FROM raw_o""")
    q["d12_parse_money"] = raw("products", body=f"""
SELECT product_id, {dbl(price('unit_price'))} AS unit_price, {dbl(cents('unit_cost'))} AS unit_cost
FROM raw_p""")
    q["d13_iqr_fences"] = raw("products", body=f", {P_PRICES}\n" + _fences("prices", "unit_price"))
    q["d13_iqr_fences_by_category"] = raw(
        "products", body=f", {P_PRICES}\n" + _fences("prices", "unit_price", "category"))
    q["d13_iqr_fences_lines"] = over("ln", body=_fences("ln", "line_total"))
    q["d14_zscore"] = raw("orders", body=f""", {O_SHIPPING}
SELECT order_id, {dbl('shipping_cost')} AS shipping_cost,
       COALESCE(abs(shipping_cost - mu) / NULLIF(sigma, 0) > 3, false) AS z_outlier
FROM shipping, {SHIP_STATS}""")
    q["d15_cap_prices"] = raw("products", body=f""", {P_PRICES}
SELECT product_id, category, {dbl('CASE WHEN unit_price > hi THEN CAST(hi AS DECIMAL(18,2)) ELSE unit_price END')}
         AS unit_price, CAST(COALESCE(unit_price > hi, false) AS BIGINT) AS capped
FROM prices, (SELECT {fence('unit_price')} AS hi FROM prices)""")
    q["d15_cap_shipping"] = raw("orders", body=f""", {O_SHIPPING}
, judged AS (SELECT *, shipping_cost > hi OR abs(shipping_cost - mu) / sigma > 3 AS far
  FROM shipping, {SHIP_STATS})
SELECT order_id, {dbl('CASE WHEN far THEN CAST(hi AS DECIMAL(18,2)) ELSE shipping_cost END')} AS shipping_cost,
       CAST(far AS BIGINT) AS capped FROM judged""")
    q["d16_margin_flag"] = raw("products", body=f"""
SELECT product_id, CASE WHEN {price('unit_price')} < {cents('unit_cost')} THEN 1 ELSE 0 END AS margin_flag
FROM raw_p""")
    q["d17_abs_quantity"] = raw("order_items", body="""
SELECT CASE WHEN CAST(quantity AS INT) = 0 THEN 1 ELSE abs(CAST(quantity AS INT)) END AS quantity,
       COUNT(*) AS lines FROM raw_i GROUP BY 1""")
    q["d18_group_median"] = raw("products", body="""
SELECT product_id, category, COALESCE(TRY_CAST(weight_kg AS DOUBLE),
  quantile_cont(TRY_CAST(weight_kg AS DOUBLE), 0.5) OVER (PARTITION BY category)) AS weight_kg FROM raw_p""")
    q["d19_ship_before_order"] = over("ln", "od", body="""
SELECT order_id, CASE WHEN ship_date >= order_date THEN ship_date END AS ship_date, order_date
FROM ln JOIN od USING (order_id)""")
    q["d20_fill_constant"] = raw("returns", body="""
SELECT COALESCE(reason, 'Unknown') AS reason, COUNT(*) AS returns FROM raw_r GROUP BY 1""")
    q["d21_orphan_flag"] = raw("orders", body="""
SELECT order_id, customer_id, CAST(customer_id IS NULL AS INT) AS orphaned_order FROM raw_o""")
    q["d22_date_parts"] = over("od", body="""
SELECT order_id, order_date, CAST(year(order_date) AS INT) AS order_year,
       strftime(order_date, '%Y-%m') AS order_month, dayname(order_date) AS order_dow FROM od""")
    typed_lines = (f"lines AS (SELECT {number('order_id')} AS order_id, "
                   f"{number('product_id')} AS product_id, item_id, {cents('unit_price')} AS unit_price "
                   "FROM raw_i)")
    q["d23_price_lookup"] = raw("order_items", body=f""", {typed_lines}
SELECT order_id, product_id, item_id,
       {dbl('COALESCE(unit_price, CAST(p_retailprice AS DECIMAL(18,2)))')} AS unit_price
FROM lines LEFT JOIN part ON product_id = p_partkey""")
    q["d24_split_orphans"] = raw("order_items", body=f""", {typed_lines}
SELECT CASE WHEN p_partkey IS NULL THEN 'rejected' ELSE 'kept' END AS table_name, COUNT(*) AS row_count
FROM lines LEFT JOIN part ON product_id = p_partkey GROUP BY 1""")
    q["d25_fk_report"] = raw("orders", "order_items", "returns", body=f"""
SELECT 'orders' AS child, 'customers' AS parent, 'customer_id' AS key, COUNT(*) AS orphans FROM raw_o
WHERE {number('customer_id')} NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'order_items', 'orders', 'order_id', COUNT(*) FROM raw_i
WHERE {number('order_id')} NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'returns', 'orders', 'order_id', COUNT(*) FROM raw_r
WHERE {number('order_id')} NOT IN (SELECT o_orderkey FROM orders)""")
    q["d26_clip_discount"] = raw("order_items", body=f"""
SELECT {dbl(DISCOUNT)} AS discount_pct, COUNT(*) AS lines FROM raw_i GROUP BY 1""")
    q["d27_line_total"] = raw("order_items", body=f"""
SELECT order_id, item_id, {dbl(f"ROUND(abs({number('quantity', 'INT')}) * {cents('unit_price')} * (1 - {DISCOUNT}), 2)")}
  AS line_total FROM raw_i""")
    for key in ("q12_channel_performance", "q19_revenue_by_weekday"):
        q[f"s02_{key.split('_')[0]}_on_stored_layout"] = named_queries()[key]
    q["s03_keyed_append"] = over("od", "cu", body="""
, o AS (SELECT order_id, customer_id, order_date, channel, status FROM od),
batch AS (
  SELECT CASE WHEN order_id % 17 <> 0 THEN order_id END AS order_id,
         CASE WHEN order_id % 11 = 0 THEN customer_id + 10000000 WHEN order_id % 13 <> 0 THEN customer_id END AS customer_id,
         order_date, CASE WHEN order_id % 6 = 0 THEN 'changed' ELSE channel END AS channel,
         CASE WHEN v = 1 THEN 'Z' ELSE status END AS status
  FROM o, (SELECT 0 AS v, 0 AS copy UNION ALL SELECT 1, 0 UNION ALL SELECT 0, 1)
  WHERE (v = 0 AND copy = 0) OR (copy = 1 AND order_id % 5 = 0) OR (v = 1 AND order_id % 7 = 0 AND order_id % 5 <> 0)),
folded AS (SELECT *, COUNT(*) AS copies FROM batch GROUP BY ALL),
judged AS (
  SELECT b.*, CASE
      WHEN b.order_id IS NULL THEN 'no key'
      WHEN b.customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cu WHERE cu.customer_id = b.customer_id) THEN 'no parent: customer_id'
      WHEN s.order_id IS NOT NULL AND s.customer_id IS NOT DISTINCT FROM b.customer_id AND s.order_date IS NOT DISTINCT FROM b.order_date
           AND s.channel IS NOT DISTINCT FROM b.channel AND s.status IS NOT DISTINCT FROM b.status THEN 'known'
      WHEN s.order_id IS NOT NULL THEN 'key taken' ELSE 'new' END AS verdict
  FROM folded b LEFT JOIN (SELECT * FROM o WHERE order_id % 3 = 0) s ON s.order_id = b.order_id)
SELECT order_id, customer_id, order_date, channel, status, copies,
       CASE WHEN verdict = 'new' AND ROW_NUMBER() OVER (
              PARTITION BY order_id, verdict ORDER BY customer_id NULLS FIRST, order_date NULLS FIRST, channel, status) > 1
            THEN 'key repeated' ELSE verdict END AS verdict
FROM judged""")
    q["d28_dense_id"] = over("ln", body="""
SELECT *, ROW_NUMBER() OVER (ORDER BY order_id, item_id, product_id, quantity) AS line_id
FROM (SELECT DISTINCT order_id, CAST(item_id AS BIGINT) AS item_id, product_id, quantity FROM ln)""")
    q["d29_quality_report"] = _quality()
    q["d30_clean_customers"] = clean("c", "SELECT * FROM clean_c")
    q["d30_clean_products"] = clean("p", _doubles("clean_p", "unit_cost", "unit_price"))
    q["d30_clean_orders"] = clean("o", _doubles("clean_o", "shipping_cost", "discount_amount"))
    q["d30_clean_order_items"] = clean(
        "poi", _doubles("clean_i", "unit_price", "discount_pct", "line_total"))
    q["d30_clean_returns"] = clean("por", _doubles("clean_r", "refund_amount"))
    q["s05_q07_on_clean_star"] = _on_clean("q07_category_rank")
    q["s05_q12_on_clean_star"] = _on_clean("q12_channel_performance")
    q["s05_m05_on_clean_star"] = clean("poi", f"""
, n AS (SELECT channel, {dbl('SUM(quantity * unit_price * discount_pct)')} AS total_discount
  FROM clean_i JOIN clean_o USING (order_id) GROUP BY channel)
SELECT channel, {r2('n.total_discount')} AS total_discount FROM (SELECT DISTINCT channel FROM clean_o)
LEFT JOIN n USING (channel)""")
    q["d30_integrity"] = clean("cpoir", """
SELECT 'orders' AS child, 'customers' AS parent, 'customer_id' AS key, COUNT(*) AS orphans FROM clean_o
WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM clean_c)
UNION ALL SELECT 'order_items', 'orders', 'order_id', COUNT(*) FROM clean_i
WHERE order_id NOT IN (SELECT order_id FROM clean_o)
UNION ALL SELECT 'returns', 'orders', 'order_id', COUNT(*) FROM clean_r
WHERE order_id NOT IN (SELECT order_id FROM clean_o)""")
    return q
