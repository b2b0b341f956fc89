"""DuckDB SQL that answers each registered query its own way, for the side-by-side check.

Written against flat CTEs with plain joins, distinct counts, self joins and
``quantile_cont``: another road to the same numbers than the Spark plans take.
"""

from __future__ import annotations

# Line grain: every order line with its order, product and customer.
CTE = {
    "ln": """ln AS (
  SELECT l_orderkey AS order_id, l_linenumber AS item_id, l_partkey AS product_id,
         CAST(l_quantity AS INT) AS quantity,
         CAST(ROUND(l_extendedprice / l_quantity * 100) / 100 AS DECIMAL(18,2)) AS unit_price,
         CAST(l_discount AS DECIMAL(5,4)) AS discount_pct,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2))
              * (1 - CAST(l_discount AS DECIMAL(5,4))), 2) AS DECIMAL(18,2)) AS line_total,
         l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem)""",
    "pr": """pr AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_size AS VARCHAR) AS sub_category, p_brand AS brand,
         CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)), 2)
              AS DECIMAL(18,2)) AS unit_cost,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price
  FROM part)""",
    "cu": """cu AS (
  SELECT c_custkey AS customer_id, replace(c_name, '#', ' ') AS customer_name,
         c_mktsegment AS loyalty_tier, n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "od": """od AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderpriority AS channel, o_orderstatus AS status, n_name AS state,
         o_orderstatus IN ('F', 'O') AS counts
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    # everything flat, all statuses
    "fa": """fa AS (
  SELECT ln.*, od.customer_id, od.order_date, od.channel, od.status, od.state, od.counts,
         pr.product_name, pr.category, pr.brand, pr.unit_cost,
         line_total - quantity * unit_cost AS profit
  FROM ln JOIN od USING (order_id) JOIN pr USING (product_id))""",
    # revenue rows only
    "f": "f AS (SELECT * FROM fa WHERE counts)",
    "rt": """rt AS (
  SELECT order_id, product_id, ship_date AS return_date, l_linestatus AS reason,
         line_total AS refund_amount
  FROM ln WHERE l_returnflag = 'R')""",
}
NEEDS = {
    "fa": ("ln", "od", "pr"), "f": ("fa",), "rt": ("ln",),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    found: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        if name not in found:
            found.append(name)

    for name in names:
        add(name)
    return found


def over(*ctes: str, body: str, extra: str = "") -> str:
    """``body`` behind the named CTEs (and those that they need); ``extra`` adds CTEs after."""
    parts = [CTE[n] for n in _closure(ctes)] + ([extra] if extra else [])
    return "WITH " + ",\n".join(parts) + "\n" + body


def r2(x: str) -> str:
    return f"ROUND(({x}) * 100) / 100"


def rk(x: str, places: int) -> str:
    factor = 10 ** places
    return f"ROUND(({x}) * {factor}.0) / {factor}.0"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"{dbl(a)} / NULLIF({dbl(b)}, 0)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


N_ORDERS = "COUNT(DISTINCT order_id)"
N_CUSTOMERS = "COUNT(DISTINCT customer_id)"
REV = "SUM(line_total)"
MONTH = "strftime(order_date, '%Y-%m')"
YEAR = "strftime(order_date, '%Y')"

MONTHLY = f"monthly AS (SELECT {MONTH} AS month, {REV} AS rev FROM f GROUP BY 1)"
DAILY = f"daily AS (SELECT order_date, {REV} AS rev FROM f GROUP BY 1)"


def _case(column: str, op: str, pairs: list[tuple[str, str]], rest: str) -> str:
    whens = " ".join(f"WHEN {column} {op} {bound} THEN '{label}'" for bound, label in pairs)
    return f"CASE {whens} ELSE '{rest}' END"


DISCOUNT_BAND = _case(
    "discount_pct", "<=",
    [("0", "0% (no discount)"), ("0.02", "1-10%"), ("0.05", "11-20%"), ("0.08", "21-30%")],
    "31%+",
)


def _rolling(days: int) -> str:
    return over("f", extra=DAILY, body=f"""
SELECT x.order_date, {dbl('x.rev')} AS daily_revenue,
       {dbl('SUM(y.rev)')} AS rolling_{days}d_revenue
       {', COUNT(*) AS days_in_window' if days == 90 else ''}
FROM daily x JOIN daily y
  ON y.order_date <= x.order_date AND y.order_date > x.order_date - {days}
GROUP BY x.order_date, x.rev""")


CATEGORY = f"""cat AS (
  SELECT category, {dbl(REV)} AS revenue, {dbl('SUM(profit)')} AS gross_profit,
         {r2(div('SUM(profit)', REV) + ' * 100')} AS margin_pct, {N_ORDERS} AS total_orders
  FROM f GROUP BY 1)"""


def named_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q01_revenue_summary_by_year"] = over("fa", body=f"""
SELECT {YEAR} AS year, status, {N_ORDERS} AS total_orders, {dbl(REV)} AS gross_revenue,
       {dbl('SUM(profit)')} AS gross_profit, {r2(div(REV, 'COUNT(*)'))} AS avg_line_value,
       {r2(div(REV, N_ORDERS))} AS avg_order_value
FROM fa GROUP BY ALL""")
    q["q02_monthly_revenue_mom"] = over("f", extra=MONTHLY, body=f"""
, paired AS (SELECT month, rev, LAG(rev) OVER (ORDER BY month) AS prev FROM monthly)
SELECT month, {dbl('rev')} AS revenue, {dbl('prev')} AS prev_month_revenue,
       {r2(dbl('rev - prev'))} AS mom_change, {r2(div('rev - prev', 'prev') + ' * 100')} AS mom_growth_pct
FROM paired""")
    q["q03_yoy_revenue_by_category"] = over("f", body=f"""
, yearly AS (SELECT category, {YEAR} AS year, {dbl(REV)} AS revenue FROM f GROUP BY ALL)
SELECT a.category, a.year, a.revenue, b.revenue AS prev_year_revenue,
       {r2('(a.revenue - b.revenue) / NULLIF(b.revenue, 0) * 100')} AS yoy_growth_pct
FROM yearly a ASOF LEFT JOIN yearly b ON a.category = b.category AND b.year < a.year""")
    q["q04_cumulative_revenue"] = over("f", extra=MONTHLY, body=f"""
, numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY month) AS i FROM monthly)
SELECT x.month, {dbl('x.rev')} AS revenue, {dbl('SUM(y.rev)')} AS cumulative_revenue,
       {r2(div('SUM(y.rev) FILTER (WHERE y.i > x.i - 3)', 'COUNT(*) FILTER (WHERE y.i > x.i - 3)'))}
         AS rolling_3m_avg
FROM numbered x JOIN numbered y ON y.i <= x.i GROUP BY x.month, x.rev""")
    q["q05_rolling_30d_revenue"] = _rolling(30)
    q["q06_rolling_90d_revenue"] = _rolling(90)
    q["q07_category_rank"] = over("f", extra=CATEGORY, body="""
SELECT c.*, (SELECT 1 + COUNT(*) FROM cat o WHERE o.revenue > c.revenue) AS revenue_rank,
       (SELECT 1 + COUNT(*) FROM cat o WHERE o.margin_pct > c.margin_pct) AS margin_rank,
       (SELECT 1 + COUNT(*) FROM cat o WHERE o.total_orders > c.total_orders) AS volume_rank
FROM cat c""")
    q["q08_top5_products_per_category"] = over("f", body=f"""
, named AS (
  SELECT category, product_name, brand, {dbl(REV)} AS revenue, {big('SUM(quantity)')} AS units_sold,
         {N_ORDERS} AS order_count
  FROM f GROUP BY ALL)
SELECT *, {big('DENSE_RANK() OVER (PARTITION BY category ORDER BY revenue DESC)')} AS rank_in_category
FROM named QUALIFY rank_in_category <= 5""")
    clv_band = _case("lifetime_value", ">=", [
        ("2000000", "VIP"), ("1500000", "High Value"), ("1000000", "Mid Value")], "Low Value")
    q["q09_customer_lifetime_value"] = over("f", "cu", body=f"""
, per AS (
  SELECT customer_id, customer_name, loyalty_tier, cu.state, {N_ORDERS} AS total_orders,
         {dbl(REV)} AS lifetime_value, {r2(div(REV, 'COUNT(*)'))} AS avg_order_value,
         MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
  FROM f JOIN cu USING (customer_id) GROUP BY ALL)
SELECT *, CAST(last_order_date - first_order_date AS INT) AS customer_tenure_days,
       {clv_band} AS clv_segment FROM per""")
    churn_band = _case("days_since_last_order", ">", [("180", "Churned"), ("90", "At Risk")], "Active")
    q["q10_churn_flags"] = over("od", "cu", body=f"""
, per AS (
  SELECT customer_id, MAX(order_date) AS last_order_date, COUNT(*) AS total_orders,
         CAST(DATE '2001-08-01' - MAX(order_date) AS INT) AS days_since_last_order
  FROM od WHERE counts GROUP BY 1)
SELECT cu.*, last_order_date, total_orders, days_since_last_order, {churn_band} AS churn_status
FROM per JOIN cu USING (customer_id)""")
    q["q11_new_vs_returning_revenue"] = over("od", "ln", body=f"""
, typed AS (
  SELECT *, CASE WHEN order_date = MIN(order_date) OVER (PARTITION BY customer_id)
            THEN 'New' ELSE 'Returning' END AS customer_type FROM od)
SELECT {MONTH} AS month, customer_type, {N_ORDERS} AS orders, {N_CUSTOMERS} AS customers,
       {dbl(REV)} AS revenue
FROM typed JOIN ln USING (order_id) WHERE counts GROUP BY ALL""")
    q["q12_channel_performance"] = over("f", body=f"""
SELECT channel, {N_ORDERS} AS total_orders, {N_CUSTOMERS} AS unique_customers,
       {dbl(REV)} AS total_revenue, {r2(div(REV, N_ORDERS))} AS avg_order_value,
       {dbl('SUM(profit)')} AS gross_profit, {r2(div('SUM(profit)', REV) + ' * 100')} AS margin_pct,
       {r2(div('SUM(discount_pct)', 'COUNT(*)') + ' * 100')} AS avg_discount_pct
FROM f GROUP BY channel""")
    q["q13_aov_by_channel_year"] = over("f", body=f"""
, aov AS (SELECT channel, {YEAR} AS year, {r2(div(REV, N_ORDERS))} AS aov FROM f GROUP BY ALL)
SELECT a.*, b.aov AS next_year_aov, {r2('(b.aov - a.aov) / NULLIF(a.aov, 0) * 100')} AS yoy_aov_change_pct
FROM aov a ASOF LEFT JOIN aov b ON a.channel = b.channel AND b.year > a.year""")
    q["q14_return_rate_by_category_reason"] = over("f", "rt", extra=CATEGORY, body=f"""
SELECT category, reason, COUNT(*) AS return_count, {dbl('SUM(refund_amount)')} AS total_refund,
       {r2(div('SUM(refund_amount)', 'COUNT(*)'))} AS avg_refund, total_orders,
       {r2(div('COUNT(*)', 'total_orders') + ' * 100')} AS return_rate_pct
FROM rt JOIN pr USING (product_id) JOIN cat USING (category)
GROUP BY category, reason, total_orders""")
    freq_band = _case("n", "<=", [
        ("1", "1 order (one-time)"), ("3", "2-3 orders"), ("6", "4-6 orders"),
        ("10", "7-10 orders")], "10+ orders (loyal)")
    q["q15_order_frequency"] = over("od", body=f"""
, freq AS (SELECT customer_id, COUNT(*) AS n FROM od WHERE counts GROUP BY 1),
banded AS (SELECT {freq_band} AS frequency_bucket, n FROM freq)
SELECT frequency_bucket, COUNT(*) AS customers, {rk(div('SUM(n)', 'COUNT(*)'), 1)} AS avg_orders_in_bucket,
       {r2(div('COUNT(*)', '(SELECT COUNT(*) FROM freq)') + ' * 100')} AS pct_of_customers
FROM banded GROUP BY 1""")
    q["q16_top20_customers"] = over("f", "cu", body=f"""
, per AS (
  SELECT customer_id, customer_name, loyalty_tier, cu.state, {N_ORDERS} AS total_orders,
         {dbl(REV)} AS lifetime_value, MIN(order_date) AS first_order, MAX(order_date) AS last_order,
         {big(f'ROW_NUMBER() OVER (ORDER BY {REV} DESC, customer_id)')} AS rank
  FROM f JOIN cu USING (customer_id) GROUP BY ALL)
SELECT * FROM per WHERE rank <= 20""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4"))
    q["q17_discount_impact"] = over("f", body=f"""
SELECT {DISCOUNT_BAND} AS discount_bucket, COUNT(*) AS line_items, {big('SUM(quantity)')} AS units_sold,
       {dbl(REV)} AS revenue, {dbl('SUM(profit)')} AS gross_profit,
       {r2(div('SUM(profit)', REV) + ' * 100')} AS margin_pct,
       {r2(div(REV, 'COUNT(*)'))} AS avg_line_value
FROM f GROUP BY 1""")
    q["q18_cohort_revenue"] = over("od", "ln", body=f"""
, born AS (SELECT customer_id, MIN(order_date) AS first_date FROM od GROUP BY 1),
placed AS (
  SELECT strftime(first_date, '%Y-%m') AS cohort_month, {MONTH} AS order_month, customer_id, line_total,
         CAST(date_diff('month', first_date, order_date) AS INT) AS month_index
  FROM od JOIN born USING (customer_id) JOIN ln USING (order_id) WHERE counts)
SELECT cohort_month, order_month, month_index, {dbl(REV)} AS cohort_revenue,
       {N_CUSTOMERS} AS active_customers
FROM placed WHERE month_index <= 12 GROUP BY ALL""")
    q["q19_revenue_by_weekday"] = over("f", body=f"""
SELECT isodow(order_date) || '-' || dayname(order_date) AS day_of_week, {N_ORDERS} AS total_orders,
       {dbl(REV)} AS total_revenue, {r2(div(REV, N_ORDERS))} AS avg_order_value
FROM f GROUP BY 1""")
    q["q20_product_affinity"] = over("fa", body="""
, named AS (
  SELECT *, (SELECT MIN(product_id) FROM pr WHERE pr.product_name = fa.product_name
             AND pr.category = fa.category) AS lowest FROM fa)
SELECT x.product_name AS product_a, y.product_name AS product_b, x.category AS category_a,
       y.category AS category_b, COUNT(*) AS times_bought_together
FROM named x JOIN named y ON x.order_id = y.order_id AND x.product_id < y.product_id
GROUP BY 1, 2, 3, 4, x.lowest, y.lowest ORDER BY 5 DESC, x.lowest, y.lowest LIMIT 30""")
    q["q21_revenue_by_loyalty_tier"] = over("f", "cu", body=f"""
SELECT loyalty_tier, {N_CUSTOMERS} AS customers, {N_ORDERS} AS total_orders, {dbl(REV)} AS total_revenue,
       {r2(div(REV, N_CUSTOMERS))} AS revenue_per_customer, {r2(div(REV, N_ORDERS))} AS avg_order_value
FROM f JOIN cu USING (customer_id) GROUP BY 1""")
    q["q22_geographic_revenue_by_state"] = over("f", body=f"""
SELECT state, {N_ORDERS} AS total_orders, {N_CUSTOMERS} AS unique_customers, {dbl(REV)} AS total_revenue,
       {r2(div(REV, N_CUSTOMERS))} AS revenue_per_customer, {r2(div(REV, N_ORDERS))} AS avg_order_value,
       {big(f'RANK() OVER (ORDER BY {REV} DESC)')} AS revenue_rank
FROM f GROUP BY state""")
    return q
