"""DuckDB counterparts of the exploratory, dashboard and measure queries."""

from __future__ import annotations

from tillwise.catalog.oracle import (
    CATEGORY, DAILY, MONTH, N_CUSTOMERS, N_ORDERS, REV, big, dbl, div, over, r2, rk,
)
from tillwise.catalog.report_queries import GROUPED_MEASURES, SLICED

AS_OF = "DATE '2001-08-01'"
ALL_ORDERS = "(SELECT COUNT(*) FROM od WHERE counts)"

RFM = f"""base AS (
  SELECT customer_id, MAX(order_date) AS last_order_date, {N_ORDERS} AS frequency, {REV} AS spend,
         CAST({AS_OF} - MAX(order_date) AS INT) AS recency FROM f GROUP BY 1),
edges AS (
  SELECT quantile_cont({dbl('recency')}, [0.2, 0.4, 0.6, 0.8]) AS re,
         quantile_cont({dbl('frequency')}, [0.2, 0.4, 0.6, 0.8]) AS fe,
         quantile_cont({dbl('spend')}, [0.2, 0.4, 0.6, 0.8]) AS me FROM base),
scored AS (
  SELECT base.*, CAST(5 - len(list_filter(re, lambda e: recency > e)) AS INT) AS r,
         CAST(1 + len(list_filter(fe, lambda e: frequency > e)) AS INT) AS q,
         CAST(1 + len(list_filter(me, lambda e: {dbl('spend')} > e)) AS INT) AS m FROM base, edges),
rfm AS (
  SELECT *, CASE WHEN r >= 4 AND q >= 4 AND m >= 4 THEN 'Champions'
    WHEN r >= 3 AND q >= 3 THEN CASE WHEN m >= 4 THEN 'Loyal Customers'
      WHEN m <= 3 THEN 'Potential Loyalists' END
    WHEN r >= 4 AND q <= 2 THEN 'New Customers'
    WHEN r <= 2 AND q >= 3 THEN 'At Risk'
    WHEN r = 1 AND q = 2 THEN 'Lost'
    WHEN r + q + m >= 9 THEN 'Promising' ELSE 'Hibernating' END AS segment FROM scored)"""
SEGMENTS = f"""seg AS (
  SELECT segment, COUNT(*) AS customers, {r2(div('SUM(spend)', 'COUNT(*)'))} AS avg_revenue,
         {dbl('SUM(spend)')} AS total_revenue FROM rfm GROUP BY 1)"""
COHORT = f"""cohort_rows AS (
  SELECT customer_id, order_date, MIN(order_date) OVER (PARTITION BY customer_id) AS born FROM f),
cohort_cells AS (
  SELECT strftime(born, '%Y-%m') AS cohort_month, date_diff('month', born, order_date) AS i,
         {N_CUSTOMERS} AS customers FROM cohort_rows GROUP BY ALL),
big_cohorts AS (SELECT cohort_month, customers AS size FROM cohort_cells WHERE i = 0 AND customers >= 20),
grid AS (
  SELECT cohort_month, j AS month_index,
         {rk(div('COALESCE(customers, 0)', 'size'), 3)} * 100 AS retention
  FROM (SELECT *, unnest(range(13)) AS j FROM big_cohorts)
  LEFT JOIN cohort_cells USING (cohort_month) WHERE i = j
  UNION ALL
  SELECT cohort_month, j, 0.0 FROM (SELECT *, unnest(range(13)) AS j FROM big_cohorts) b
  WHERE NOT EXISTS (SELECT 1 FROM cohort_cells c WHERE c.cohort_month = b.cohort_month AND c.i = b.j))"""
MATRIX = "SELECT cohort_month, {cols} FROM grid GROUP BY 1"
PRODUCT_REVENUE = """sold AS (
  SELECT pr.*, COALESCE(rev, 0) AS revenue
  FROM pr LEFT JOIN (SELECT product_id, SUM(line_total) AS rev FROM ln GROUP BY 1) USING (product_id)),
shares AS (
  SELECT *, CAST(SUM(revenue) OVER (ORDER BY revenue DESC RANGE UNBOUNDED PRECEDING) AS DOUBLE)
            / CAST(SUM(revenue) OVER () AS DOUBLE) AS share FROM sold),
classed AS (
  SELECT *, CASE WHEN share <= 0.80 THEN 'A' WHEN share <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
  FROM shares)"""
CAT_PROFIT = f"""cat_profit AS (
  SELECT category, {REV} AS rev, SUM(profit) AS profit FROM f GROUP BY 1)"""
RETURN_RATE = f"""rate AS (
  SELECT category, returns, orders, {rk(div('returns', 'orders') + ' * 100', 4)} AS return_rate
  FROM (SELECT category, COUNT(*) AS returns FROM rt LEFT JOIN ln USING (order_id, product_id)
        JOIN pr USING (product_id) GROUP BY 1)
  JOIN (SELECT category, {N_ORDERS} AS orders FROM f GROUP BY 1) USING (category))"""
MONTHS = f"""by_month AS (
  SELECT {MONTH} AS order_month, {REV} AS rev, {N_ORDERS} AS orders FROM f GROUP BY 1),
numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY order_month) AS i FROM by_month)"""
MEAN3 = r2(div("SUM(y.rev)", "COUNT(*)"))

# Orders of every status with their lines, where they have any.
WIDE = f"""wide AS (
  SELECT od.order_id, od.customer_id, od.order_date, od.channel, od.status, od.state, od.counts,
         year(od.order_date) AS year, strftime(od.order_date, '%Y-%m') AS month, cu.loyalty_tier,
         ln.order_id AS line_order, ln.product_id, quantity, ln.unit_price, discount_pct, line_total,
         unit_cost, category, brand
  FROM od JOIN cu USING (customer_id) LEFT JOIN ln ON ln.order_id = od.order_id
  LEFT JOIN pr ON pr.product_id = ln.product_id)"""
COST = "SUM(quantity * unit_cost)"
MEASURE_SQL = {
    "total_revenue": dbl(REV),
    "total_cost": dbl(COST),
    "gross_profit": dbl(f"{REV} - {COST}"),
    "profit_margin": rk(div(f"{REV} - {COST}", REV), 4),
    "total_discount": r2(dbl("SUM(quantity * unit_price * discount_pct)")),
    "average_order_value": r2(div(REV, N_ORDERS)),
    "revenue_per_customer": r2(div(REV, N_CUSTOMERS)),
    "revenue_per_unit": rk(div(REV, "SUM(quantity)"), 4),
    "total_orders": N_ORDERS,
    "units_sold": big("SUM(quantity)"),
    "completed_orders": "COUNT(DISTINCT CASE WHEN counts THEN order_id END)",
    "avg_items_per_order": rk(div("SUM(quantity)", "COUNT(DISTINCT line_order)"), 4),
    "avg_customer_lifetime_value": r2(div(REV, "(SELECT COUNT(*) FROM cu)")),
}
SERIES = f"""spine AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', MIN(order_date)),
         date_trunc('month', MAX(order_date)), INTERVAL 1 MONTH)) AS DATE) AS m FROM od),
per AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS m, {REV} AS rev, SUM(profit) AS profit
  FROM fa GROUP BY 1),
s AS (SELECT m, strftime(m, '%Y-%m') AS month, rev, profit FROM spine LEFT JOIN per USING (m))"""


def _lagged(months: int, value: str) -> str:
    return f"""SELECT a.month, {value}
FROM s a LEFT JOIN s b ON b.m = CAST(a.m - INTERVAL {months} MONTH AS DATE)"""


def _trailing(months: int, value: str) -> str:
    return f"""SELECT a.month, {value}
FROM s a JOIN s b ON b.m <= a.m AND b.m > CAST(a.m - INTERVAL {months} MONTH AS DATE)
GROUP BY a.month, a.rev"""


def _histogram(bins: int) -> str:
    parts = []
    for metric, column in (("recency", "recency"), ("frequency", "frequency"), ("monetary", "spend")):
        c = dbl(column)
        parts.append(f"""
SELECT '{metric}' AS metric, CAST(b AS INT) AS bin, {rk(f'lo + b * ((hi - lo) / {bins})', 4)} AS lower,
       {rk(f'lo + (b + 1) * ((hi - lo) / {bins})', 4)} AS upper,
       (SELECT COUNT(*) FROM base WHERE least(floor(({c} - lo) / (hi - lo) * {bins}), {bins - 1}) = b) AS n,
       {rk('med', 4)} AS median
FROM (SELECT MIN({c}) AS lo, MAX({c}) AS hi, quantile_cont({c}, 0.5) AS med, unnest(range({bins})) AS b
      FROM base)""")
    return over("f", extra=RFM, body="\nUNION ALL".join(parts))


LINE = (f"CAST(item_id AS BIGINT) AS item_id, order_id, product_id, quantity, "
        f"{dbl('ln.unit_price')} AS unit_price, {dbl('discount_pct')} AS discount_pct, "
        f"{dbl('line_total')} AS line_total")
FACT = f"""SELECT {LINE}, od.customer_id, od.order_date, od.channel, od.status, od.state AS state_order,
       cu.loyalty_tier, cu.state AS state_cust, product_name, category, sub_category, brand,
       {dbl('unit_cost')} AS unit_cost{{more}}
FROM ln LEFT JOIN od USING (order_id) LEFT JOIN cu USING (customer_id) LEFT JOIN pr USING (product_id)"""
PROFIT = dbl("line_total - quantity * unit_cost")


def _channel_years() -> str:
    return over("f", body=f"""
, a AS (SELECT channel, CAST(year(order_date) AS INT) AS year, {r2(div(REV, N_ORDERS))} AS aov FROM f GROUP BY ALL)
SELECT c.channel, y.year, COALESCE(a.aov, 0.0) AS aov
FROM (SELECT DISTINCT channel FROM a) c CROSS JOIN (SELECT DISTINCT year FROM a) y
LEFT JOIN a ON a.channel = c.channel AND a.year = y.year""")


def eda_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["e01_master_fact"] = over("ln", "od", "cu", "pr", body=FACT.format(more=""))
    q["e02_revenue_fact"] = over(
        "ln", "od", "cu", "pr",
        body=FACT.format(more=f", {PROFIT} AS gross_profit") + " WHERE counts")
    q["e03_monthly_trend"] = over("f", extra=MONTHS, body=f"""
SELECT x.order_month, {dbl('x.rev')} AS revenue, x.orders, {MEAN3} AS revenue_3m_avg
FROM numbered x JOIN numbered y ON y.i BETWEEN x.i - 2 AND x.i GROUP BY ALL""".replace(
        "GROUP BY ALL", "GROUP BY x.order_month, x.rev, x.orders"))
    q["e04_annual_revenue"] = over("f", body=f"""
SELECT CAST(year(order_date) AS INT) AS order_year, {dbl(REV)} AS revenue FROM f GROUP BY 1""")
    q["e05_orders_by_weekday"] = over("od", body="""
SELECT dayname(order_date) AS order_dow, COUNT(*) AS orders FROM od WHERE counts GROUP BY 1""")
    q["e06_category_margin"] = over("f", extra=CAT_PROFIT, body=f"""
, m AS (SELECT category, {dbl('rev')} AS revenue, {dbl('profit')} AS profit,
       {rk(div('profit', 'rev') + ' * 100', 1)} AS margin_pct FROM cat_profit)
SELECT *, (SELECT {rk('AVG(margin_pct)', 4)} FROM m) AS avg_margin_pct FROM m""")
    q["e07_channel_revenue"] = over("f", body=f"SELECT channel, {dbl(REV)} AS revenue FROM f GROUP BY 1")
    q["e07_category_share"] = over("f", body=f"""
SELECT category, {dbl(REV)} AS revenue, {rk(div(REV, '(SELECT SUM(line_total) FROM f)') + ' * 100', 1)}
  AS share_pct FROM f GROUP BY 1""")
    q["e08_top_states"] = over("f", body=f"""
SELECT state, {dbl(REV)} AS revenue FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
    q["e09_rfm_base"] = over("f", extra=RFM, body=f"""
SELECT customer_id, last_order_date, frequency, {dbl('spend')} AS monetary, recency FROM base""")
    rfm = over("f", extra=RFM, body=f"""
SELECT customer_id, last_order_date, frequency, {dbl('spend')} AS monetary, recency, r AS R_score,
       q AS F_score, m AS M_score, CAST(r * 100 + q * 10 + m AS VARCHAR) AS RFM_score, segment FROM rfm""")
    q["e10_rfm_segments"] = rfm
    # No NULL recency and no repeated edge at the checked size: both modes agree there.
    q["e10_rfm_segments_parity"] = rfm
    cols = ", ".join(
        f'MAX(retention) FILTER (WHERE month_index = {i}) AS "{i}"' for i in range(13))
    q["e11_cohort_retention"] = over("f", extra=COHORT, body=MATRIX.format(cols=cols))
    q["e12_retention_curve"] = over("f", extra=COHORT, body=f"""
SELECT CAST(month_index AS INT) AS month_index, {rk('AVG(retention)', 4)} AS avg_retention
FROM grid GROUP BY 1""")
    q["e13_segment_summary"] = over("f", extra=f"{RFM},\n{SEGMENTS}", body="SELECT * FROM seg")
    q["e14_rfm_distributions"] = _histogram(40)
    q["e15_return_rate_by_category"] = over("f", "rt", extra=RETURN_RATE, body="SELECT * FROM rate")
    q["e15_return_rate_no_fan_out"] = over("f", "rt", body=f"""
SELECT category, returns, orders, {rk(div('returns', 'orders') + ' * 100', 4)} AS return_rate
FROM (SELECT category, COUNT(*) AS returns FROM rt JOIN pr USING (product_id) GROUP BY 1)
JOIN (SELECT category, {N_ORDERS} AS orders FROM f GROUP BY 1) USING (category)""")
    q["e16_return_reasons"] = over("rt", body="SELECT reason, COUNT(*) AS returns FROM rt GROUP BY 1")
    q["e17_monthly_return_rate"] = over("od", "rt", body=f"""
, o AS (SELECT {MONTH} AS order_month, COUNT(*) AS n FROM od WHERE counts GROUP BY 1),
r AS (SELECT {MONTH} AS order_month, COUNT(*) AS n FROM rt JOIN od USING (order_id) GROUP BY 1)
SELECT order_month, {rk(div('r.n', 'o.n') + ' * 100', 4)} AS return_rate FROM o JOIN r USING (order_month)""")
    q["e18_top20_products"] = over("f", body=f"""
SELECT product_name, {dbl(REV)} AS revenue FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
    up = dbl("unit_price")
    q["e19_price_boxes"] = over("pr", body=f"""
, b AS (SELECT category, quantile_cont({up}, 0.25) AS q1, quantile_cont({up}, 0.5) AS median,
        quantile_cont({up}, 0.75) AS q3 FROM pr GROUP BY 1),
x AS (SELECT b.*, {up} AS v, {up} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM pr JOIN b USING (category))
SELECT category, {rk('q1', 4)} AS q1, {rk('median', 4)} AS median, {rk('q3', 4)} AS q3,
       {rk('MIN(v) FILTER (WHERE inside)', 4)} AS whisker_low,
       {rk('MAX(v) FILTER (WHERE inside)', 4)} AS whisker_high, COUNT(*) FILTER (WHERE NOT inside) AS outliers
FROM x GROUP BY x.category, x.q1, x.median, x.q3""")
    q["e20_headline"] = over("f", "rt", "cu", extra=f"{CAT_PROFIT},\n{RFM},\n{SEGMENTS}", body=f"""
SELECT {dbl(REV)} AS total_revenue, {dbl('SUM(profit)')} AS total_profit,
       {rk(div('SUM(profit)', REV) + ' * 100', 4)} AS margin_pct, {ALL_ORDERS} AS total_orders,
       (SELECT COUNT(*) FROM cu) AS total_customers, {r2(div(REV, ALL_ORDERS))} AS avg_order_value,
       {rk(div('(SELECT COUNT(*) FROM rt)', ALL_ORDERS) + ' * 100', 4)} AS return_rate_pct,
       (SELECT category FROM cat_profit ORDER BY rev DESC LIMIT 1) AS top_category,
       (SELECT channel FROM f GROUP BY 1 ORDER BY {REV} DESC LIMIT 1) AS top_channel,
       (SELECT segment FROM seg ORDER BY total_revenue DESC LIMIT 1) AS best_segment,
       (SELECT customers FROM seg ORDER BY total_revenue DESC LIMIT 1) AS best_segment_customers,
       (SELECT MAX(total_revenue) FROM seg) AS best_segment_revenue
FROM f""")
    q["e21_summary_report"] = over("f", "rt", extra=f"{RFM},\n{SEGMENTS},\n{RETURN_RATE}", body=f"""
SELECT 'annual_revenue' AS section, CAST(year(order_date) AS VARCHAR) AS item, 'revenue' AS measure,
       {dbl(REV)} AS value FROM f GROUP BY ALL
UNION ALL SELECT 'segments', segment, 'customers', {dbl('customers')} FROM seg
UNION ALL SELECT 'segments', segment, 'avg_revenue', avg_revenue FROM seg
UNION ALL SELECT 'segments', segment, 'total_revenue', total_revenue FROM seg
UNION ALL SELECT 'return_rates', category, 'return_rate', return_rate FROM rate""")
    return q


def dashboard_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["p01_dashboard_fact"] = over("ln", "od", "pr", body=f"""
SELECT {LINE}, order_date, CAST(date_trunc('month', order_date) AS DATE) AS order_month, channel, status,
       state, customer_id, category, {dbl('unit_cost')} AS unit_cost, brand, {PROFIT} AS gross_profit
FROM ln JOIN od USING (order_id) LEFT JOIN pr USING (product_id) WHERE counts""")
    q["p02_monthly_change"] = over("f", extra=MONTHS, body=f"""
, means AS (SELECT x.i, {MEAN3} AS rev_3m FROM numbered x JOIN numbered y ON y.i BETWEEN x.i - 2 AND x.i
  GROUP BY 1)
SELECT a.order_month, {dbl('a.rev')} AS revenue, a.orders, rev_3m,
       {rk(div('a.rev - b.rev', 'b.rev') + ' * 100', 4)} AS mom_pct
FROM numbered a JOIN means USING (i) LEFT JOIN numbered b ON b.i = a.i - 1""")
    q["p03_page_kpis"] = over("f", "rt", "cu", body=f"""
, y AS (SELECT SUM(line_total) FILTER (WHERE year(order_date) = 1999) AS y1,
        SUM(line_total) FILTER (WHERE year(order_date) = 2000) AS y2 FROM f)
SELECT {dbl(REV)} AS total_revenue, {dbl('SUM(profit)')} AS total_profit,
       {rk(div('SUM(profit)', REV), 6)} AS margin, {ALL_ORDERS} AS total_orders,
       (SELECT COUNT(*) FROM cu) AS total_customers, {r2(div(REV, ALL_ORDERS))} AS avg_order_value,
       {rk(div('(SELECT COUNT(*) FROM rt)', ALL_ORDERS), 6)} AS return_rate,
       (SELECT {rk(div('y2 - y1', 'y1'), 6)} FROM y) AS yoy_growth
FROM f""")
    q["p04_trailing_revenue"] = over("f", extra=MONTHS, body=f"""
SELECT {dbl('SUM(rev) FILTER (WHERE i > (SELECT MAX(i) - 3 FROM numbered))')} AS rolling_3m,
       {dbl('SUM(rev) FILTER (WHERE i > (SELECT MAX(i) - 12 FROM numbered))')} AS rolling_12m,
       {dbl("SUM(rev) FILTER (WHERE order_month LIKE '2001-%')")} AS ytd FROM numbered""")
    q["p05_daily_trend"] = over("f", extra=DAILY, body=f"""
, n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY order_date) AS i FROM daily)
SELECT x.order_date, {dbl('x.rev')} AS revenue, {r2(div('SUM(y.rev)', 'COUNT(*)'))} AS rolling_mean
FROM n x JOIN n y ON y.i BETWEEN x.i - 29 AND x.i GROUP BY x.order_date, x.rev""")
    q["p06_aov_by_channel"] = _channel_years()
    q["p07_customer_kpis"] = over("f", "cu", extra=RFM, body=f"""
SELECT (SELECT COUNT(*) FROM cu) AS total_customers,
       (SELECT {N_CUSTOMERS} FROM f WHERE order_date >= DATE '2001-05-01') AS active_customers,
       COUNT(*) FILTER (WHERE recency > 180) AS churned_customers,
       {r2(div('SUM(spend)', 'COUNT(*)'))} AS avg_customer_value FROM base""")
    q["p08_segment_revenue"] = over("f", extra=f"{RFM},\n{SEGMENTS}", body="""
SELECT segment, customers, total_revenue AS total_rev FROM seg""")
    q["p08_distributions"] = _histogram(30)
    cols = ", ".join(
        f'MAX(retention) FILTER (WHERE month_index = {i}) AS "{i}"' for i in range(7))
    q["p09_retention_excerpt"] = over(
        "f", extra=COHORT, body=MATRIX.format(cols=cols) + " ORDER BY 1 LIMIT 10")
    q["p10_new_returning_pivot"] = over("od", "ln", body=f"""
, t AS (SELECT *, order_date = MIN(order_date) OVER (PARTITION BY customer_id) AS is_new FROM od),
x AS (SELECT t.*, line_total FROM t JOIN ln USING (order_id) WHERE counts)
SELECT {MONTH} AS month, COALESCE({dbl('SUM(line_total) FILTER (WHERE is_new)')}, 0.0) AS new_revenue,
       COALESCE({dbl('SUM(line_total) FILTER (WHERE NOT is_new)')}, 0.0) AS returning_revenue
FROM x GROUP BY 1""")
    q["p11_returns_kpis"] = over("ln", "rt", body=f"""
SELECT (SELECT {big('SUM(quantity)')} FROM ln) AS units_sold, COUNT(*) AS total_returns,
       {dbl('SUM(refund_amount)')} AS total_refunds, {r2(div('SUM(refund_amount)', 'COUNT(*)'))} AS avg_refund
FROM rt""")
    q["p12_top15_products"] = over("f", body=f"""
SELECT product_id, product_name, category, {dbl(REV)} AS revenue, {big('SUM(quantity)')} AS units
FROM f GROUP BY 1, 2, 3 ORDER BY {REV} DESC, 1 LIMIT 15""")
    q["p13_margin_vs_average"] = over("f", extra=CATEGORY, body=f"""
, a AS (SELECT AVG(margin_pct) AS mean FROM cat)
SELECT category, margin_pct, {big('RANK() OVER (ORDER BY margin_pct DESC)')} AS margin_rank,
       {rk('mean', 4)} AS avg_margin_pct, {rk('margin_pct - mean', 6)} >= 0 AS reaches_average FROM cat, a""")
    q["p13_return_rate_vs_average"] = over("f", "rt", extra=RETURN_RATE, body=f"""
, a AS (SELECT AVG(return_rate) AS mean FROM rate)
SELECT category, return_rate, {rk('mean', 4)} AS avg_return_rate,
       {rk('return_rate - mean', 6)} > 0 AS above_average FROM rate, a""")
    for key in ("category", "channel"):
        q[f"p14_revenue_by_{key}"] = over(
            "f", body=f"SELECT {key}, {dbl(REV)} AS revenue FROM f GROUP BY 1")
    q["p14_revenue_by_year"] = over("f", body=f"""
SELECT CAST(year(order_date) AS INT) AS year, {dbl(REV)} AS revenue FROM f GROUP BY 1""")
    return q


def measure_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    for key, (name, by) in GROUPED_MEASURES.items():
        if name not in MEASURE_SQL:
            continue
        cols = "".join(
            f"CAST(year AS INT) AS year, " if b == "year" else f"{b}, " for b in by)
        group = f" GROUP BY {', '.join(by)}" if by else ""
        where = " WHERE product_id IS NOT NULL" if {"category", "brand"} & set(by) else ""
        q[f"{key}_{name}"] = over("ln", "od", "cu", "pr", extra=WIDE, body=(
            f"SELECT {cols}{MEASURE_SQL[name]} AS {name} FROM wide{where}{group}"))
    q["m23_total_customers"] = over("cu", body="SELECT COUNT(*) AS total_customers FROM cu")
    q["m28_total_returns"] = over("rt", "pr", body="""
SELECT category, COUNT(*) AS total_returns FROM rt JOIN pr USING (product_id) GROUP BY 1""")
    q["m29_return_rate"] = over("rt", "od", body=f"""
, c AS (SELECT channel, COUNT(*) FILTER (WHERE counts) AS n FROM od GROUP BY 1),
r AS (SELECT channel, COUNT(*) AS n FROM rt JOIN od USING (order_id) GROUP BY 1)
SELECT channel, {rk(div('r.n', 'c.n'), 4)} AS return_rate FROM c JOIN r USING (channel)""")
    q["m30_total_refund"] = over("rt", "od", body=f"""
SELECT {MONTH} AS month, {dbl('SUM(refund_amount)')} AS total_refund
FROM od LEFT JOIN rt USING (order_id) GROUP BY 1""")

    series = {
        "m13_revenue_prev_month": _lagged(1, f"{dbl('b.rev')} AS revenue_prev_month"),
        "m14_mom_change": _lagged(
            1, f"{dbl('COALESCE(a.rev, 0) - COALESCE(b.rev, 0)')} AS mom_change"),
        "m15_mom_growth": _lagged(
            1, f"{rk(div('COALESCE(a.rev, 0) - b.rev', 'b.rev'), 6)} AS mom_growth"),
        "m16_revenue_sply": _lagged(12, f"{dbl('b.rev')} AS revenue_sply"),
        "m17_yoy_growth": _lagged(
            12, f"{rk(div('COALESCE(a.rev, 0) - b.rev', 'b.rev'), 6)} AS yoy_growth"),
        "m18_revenue_ytd": f"""SELECT a.month, {dbl('SUM(b.rev)')} AS revenue_ytd
FROM s a JOIN s b ON year(a.m) = year(b.m) AND b.m <= a.m GROUP BY 1""",
        "m19_rolling_3m_revenue": _trailing(3, f"{dbl('SUM(b.rev)')} AS rolling_3m_revenue"),
        "m20_rolling_12m_revenue": _trailing(12, f"{dbl('SUM(b.rev)')} AS rolling_12m_revenue"),
        "m21_rolling_3m_margin": _trailing(
            3, f"{rk(div('SUM(b.profit)', 'SUM(b.rev)'), 6)} AS rolling_3m_margin"),
        "m22_revenue_vs_12m_avg": _trailing(
            12, f"{r2(dbl('a.rev') + ' - ' + dbl('SUM(b.rev)') + ' / 12.0::DOUBLE')} AS revenue_vs_12m_avg"),
        "m35_target_achievement":
            f"SELECT month, {rk('COALESCE(' + dbl('rev') + ', 0.0) / 25000000.0::DOUBLE', 6)} "
            "AS target_achievement FROM s",
    }
    for key, body in series.items():
        q[key] = over("fa", extra=SERIES, body=body)

    q["m24_active_customers"] = over("fa", extra=SERIES, body=f"""
, a AS (SELECT month, least(last_day(m), (SELECT MAX(order_date) FROM od)) AS anchor FROM s)
SELECT month, COUNT(DISTINCT customer_id) AS active_customers
FROM a LEFT JOIN (SELECT * FROM od WHERE counts) o
  ON order_date <= anchor AND order_date > anchor - 90
GROUP BY 1""")
    q["m24_active_customers_by_day"] = over("od", body="""
SELECT d.date, COUNT(DISTINCT customer_id) AS active_customers
FROM (SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS DATE) AS date FROM od) d
LEFT JOIN (SELECT * FROM od WHERE counts) o ON order_date <= d.date AND order_date > d.date - 90
GROUP BY 1""")
    q["a02_customers_by_period"] = over("od", body=" UNION ALL ".join(f"""
SELECT '{grain}' AS grain, CAST(date_trunc('{grain}', order_date) AS DATE) AS start, {channel} AS channel,
       COUNT(DISTINCT customer_id) AS customers FROM od WHERE counts GROUP BY ALL"""
        for grain in ("month", "quarter", "year") for channel in ("channel", "CAST(NULL AS VARCHAR)")))
    # Orders and customers are those of the dates alone: a product filter does not reach them.
    for by in ("category", "channel"):
        orders = "o.channel = l.channel" if by == "channel" else "TRUE"
        q[f"m06_model_filters_by_{by}"] = over("fa", "rt", body=f"""
, o AS (SELECT * FROM od WHERE order_date BETWEEN DATE '1996-03-01' AND DATE '2000-09-30'),
picked AS (SELECT * FROM pr WHERE category IN ('ECONOMY', 'PROMO', 'STANDARD')
           AND brand IN ({', '.join(f"'Brand#{i}'" for i in range(1, 15))})),
l AS (SELECT o.channel, p.category, ln.quantity, ln.line_total
      FROM ln JOIN o USING (order_id) JOIN picked p USING (product_id)),
back AS (SELECT o.channel, p.category FROM rt JOIN o USING (order_id) JOIN picked p USING (product_id)),
groups AS (SELECT DISTINCT {by} AS g FROM l),
sold AS (SELECT {by} AS g, SUM(line_total) AS rev, SUM(quantity) AS units FROM l GROUP BY 1),
returned AS (SELECT {by} AS g, COUNT(*) AS returns FROM back GROUP BY 1),
counted AS (
  SELECT g, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,
         COUNT(DISTINCT CASE WHEN counts THEN order_id END) AS completed
  FROM groups l JOIN o ON {orders.replace("l.channel", "l.g")} GROUP BY 1)
SELECT g AS {by}, COALESCE({r2(div('rev', 'orders'))}, 0.0) AS average_order_value,
       COALESCE({r2(div('rev', 'customers'))}, 0.0) AS revenue_per_customer, orders AS total_orders,
       completed AS completed_orders, COALESCE({rk(div('COALESCE(returns, 0)', 'completed'), 4)}, 0.0) AS return_rate,
       {big('units')} AS units_sold
FROM sold JOIN counted USING (g) LEFT JOIN returned USING (g)""")
    # A missing recency makes everyone score 3 on it; so do repeated edges of any column.
    q["e10_parity_with_missing_dates"] = over("f", body=f"""
, base AS (
  SELECT customer_id, MAX(CASE WHEN customer_id % 50 <> 0 THEN order_date END) AS last_order_date,
         {N_ORDERS} AS frequency, {REV} AS spend FROM f GROUP BY 1),
aged AS (SELECT *, CAST({AS_OF} - last_order_date AS INT) AS recency FROM base),
edges AS (
  SELECT quantile_cont({dbl('recency')}, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS re,
         quantile_cont({dbl('frequency')}, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS fe,
         quantile_cont({dbl('spend')}, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS me,
         COUNT(*) = COUNT(recency) AS dated FROM aged),
scored AS (
  SELECT aged.*,
    CAST(CASE WHEN dated AND len(list_distinct(re)) = 6 THEN 5 - len(list_filter(re[2:5], lambda e: recency > e)) ELSE 3 END AS INT) AS r,
    CAST(CASE WHEN len(list_distinct(fe)) = 6 THEN 1 + len(list_filter(fe[2:5], lambda e: frequency > e)) ELSE 3 END AS INT) AS q,
    CAST(CASE WHEN len(list_distinct(me)) = 6 THEN 1 + len(list_filter(me[2:5], lambda e: {dbl('spend')} > e)) ELSE 3 END AS INT) AS m
  FROM aged, edges)
SELECT customer_id, last_order_date, frequency, {dbl('spend')} AS monetary, recency, r AS R_score, q AS F_score, m AS M_score,
       CAST(r * 100 + q * 10 + m AS VARCHAR) AS RFM_score,
       CASE WHEN r >= 4 AND q >= 4 AND m >= 4 THEN 'Champions'
            WHEN r >= 3 AND q >= 3 THEN CASE WHEN m >= 4 THEN 'Loyal Customers' ELSE 'Potential Loyalists' END
            WHEN r >= 4 THEN 'New Customers' WHEN r <= 2 AND q >= 3 THEN 'At Risk' WHEN r = 1 AND q = 2 THEN 'Lost'
            WHEN r + q + m >= 9 THEN 'Promising' ELSE 'Hibernating' END AS segment
FROM scored""")
    q["m25_new_customers"] = over("od", body=f"""
SELECT {MONTH} AS month, COUNT(*) AS new_customers
FROM (SELECT customer_id, MIN(order_date) AS order_date FROM od GROUP BY 1) GROUP BY 1""")
    q["m27_retention_rate"] = over("f", extra=RFM, body=f"""
SELECT {rk('AVG(CASE WHEN frequency > 1 THEN 1.0::DOUBLE ELSE 0.0 END)', 6)} AS retention_rate FROM base""")
    q["w11_cumulative_share"] = over("ln", "pr", extra=PRODUCT_REVENUE, body=f"""
SELECT {dbl('revenue')} AS revenue, COUNT(*) AS products, {rk('MIN(share)', 9)} AS cumulative_share
FROM shares GROUP BY shares.revenue""")
    q["m31_abc_class"] = over("ln", "pr", extra=PRODUCT_REVENUE, body=f"""
SELECT product_id, {dbl('revenue')} AS revenue, abc_class FROM classed""")
    for key, by in (("m32_what_if", ""), ("m32_what_if_by_month", "month")):
        col = f"{MONTH} AS month, " if by else ""
        keys = "month, " if by else ""
        group = " GROUP BY 1" if by else ""
        q[key] = over("fa", body=f"""
, b AS (SELECT {col}{dbl(REV)} AS rev FROM fa{group}),
w AS (SELECT *, unnest(range(-20, 21)) AS pct FROM b)
SELECT {keys}CAST(pct AS INT) AS adjustment_pct,
       {r2('rev * (1.0::DOUBLE + pct / 100.0::DOUBLE) - rev')} AS revenue_impact,
       {r2('rev * (1.0::DOUBLE + pct / 100.0::DOUBLE)')} AS adjusted_revenue FROM w""")
    q["m33_category_revenue_share"] = over("fa", body=f"""
SELECT category, {dbl(REV)} AS total_revenue,
       {rk(div(REV, '(SELECT SUM(line_total) FROM fa)'), 6)} AS revenue_share FROM fa GROUP BY 1""")
    q["m34_segment_revenue_share"] = over("f", extra=RFM, body=f"""
SELECT segment, {dbl(REV)} AS total_revenue,
       {rk(div(REV, '(SELECT SUM(line_total) FROM fa)'), 6)} AS revenue_share
FROM fa LEFT JOIN rfm USING (customer_id) GROUP BY 1""")
    q["m36_date_dimension"] = over("od", body="""
, d AS (SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM od)
SELECT date, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month_number,
       monthname(date) AS month_name, strftime(date, '%b') AS month_short,
       'Q' || quarter(date) AS quarter, strftime(date, '%Y-%m') AS year_month,
       strftime(date, '%Y') || ' Q' || quarter(date) AS year_quarter,
       CAST(isodow(date) AS INT) AS day_of_week, dayname(date) AS day_name,
       CASE WHEN isodow(date) > 5 THEN 'Weekend' ELSE 'Weekday' END AS is_weekend,
       CAST(strftime(date, '%U') AS INT) + CASE WHEN dayofweek(date_trunc('year', date)) = 0 THEN 0 ELSE 1 END
         AS week_number FROM d""")
    margin = f"COALESCE({r2(div(f'{REV} - {COST}', REV) + ' * 100')}, 0.0)"
    q["m37_product_detail"] = over("f", "rt", extra=RETURN_RATE, body=f"""
SELECT category, product_id, product_name, brand, {dbl(REV)} AS revenue, {big('SUM(quantity)')} AS units,
       {margin} AS margin_pct, return_rate AS category_return_rate
FROM fa JOIN rate USING (category) WHERE category = 'ECONOMY'
GROUP BY 1, 2, 3, 4, return_rate ORDER BY {REV} DESC, 2 LIMIT 10""")
    q["m38_state_tooltip"] = over("f", body=f"""
SELECT state, {dbl(REV)} AS total_revenue, {N_ORDERS} AS total_orders, {N_CUSTOMERS} AS customers,
       {r2(div(REV, N_ORDERS))} AS avg_order_value FROM f GROUP BY state""")
    q["m39_churn_risk"] = over("od", "rt", body=f"""
, l AS (SELECT customer_id, MAX(order_date) AS d FROM od WHERE counts GROUP BY 1)
SELECT COUNT(*) FILTER (WHERE {AS_OF} - d > 90) AS churn_risk_customers,
       (SELECT {r2(div('SUM(refund_amount)', 'COUNT(*)'))} FROM rt) AS avg_refund FROM l""")
    q["m40_product_table"] = over("fa", extra=PRODUCT_REVENUE, body=f"""
SELECT fa.product_id, fa.product_name, {dbl(REV)} AS revenue, {big('SUM(quantity)')} AS units,
       {r2(div(f'{REV} - SUM(quantity * fa.unit_cost)', REV) + ' * 100')} AS margin_pct, abc_class
FROM fa JOIN classed ON classed.product_id = fa.product_id
GROUP BY 1, 2, abc_class ORDER BY {REV} DESC, 1 LIMIT 20""")

    sliced = ", ".join(f"{MEASURE_SQL[m]} AS {m}" for m in SLICED)
    nations = ", ".join(f"'NATION_{i}'" for i in range(12))
    q["f09_sliced_by_orders"] = over("ln", "od", "cu", "pr", extra=WIDE, body=f"""
SELECT month, {sliced} FROM wide
WHERE year IN (1997, 1998, 1999) AND channel IN ('1-URGENT', '2-HIGH', '5-LOW') AND counts
  AND state IN ({nations}) AND loyalty_tier IN ('BUILDING', 'MACHINERY')
GROUP BY month""")
    brands = ", ".join(f"'Brand#{i}'" for i in range(1, 15))
    q["f09_sliced_by_products"] = over("f", "cu", extra=f"{WIDE},\n{PRODUCT_REVENUE},\n{RFM}", body=f"""
, joined AS (
  SELECT wide.*, classed.abc_class, rfm.segment FROM wide
  JOIN classed ON classed.product_id = wide.product_id LEFT JOIN rfm ON rfm.customer_id = wide.customer_id)
SELECT channel, {sliced} FROM joined
WHERE order_date BETWEEN DATE '1996-03-01' AND DATE '2000-09-30'
  AND category IN ('ECONOMY', 'PROMO', 'STANDARD') AND brand IN ({brands})
  AND abc_class IN ('A', 'B') AND segment IN ('Champions', 'Loyal Customers', 'At Risk')
GROUP BY channel""")
    return q


def report_oracles() -> dict[str, str]:
    return eda_oracles() | dashboard_oracles() | measure_oracles()
