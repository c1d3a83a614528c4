"""The registered queries once more, as SQL for an independent engine (DuckDB).

Each query is a final SELECT over named steps; a step names the steps it reads. Nothing here is
used to compute results, only to compare them.
"""

from __future__ import annotations

import re

from tillwise.plans.catalog import PERIOD, SINCE, YEAR


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _rnd(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def _ratio(a: str, b: str) -> str:
    return f"({_dbl(a)} / NULLIF({_dbl(b)}, 0))"


def _avg(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(28,8))) AS DOUBLE) / COUNT({x}))"


def _int(x: str) -> str:
    return f"CAST({x} AS INT)"


def _big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


_MONTH = "CAST(date_trunc('month', date) AS DATE)"
_LABEL = "strftime(month, '%Y-%m')"
_MARGIN = _rnd(_ratio("price - cost", "price") + " * 100.0", 1)


def _bin5(order: str) -> str:
    return (
        f"CAST(GREATEST(1, CEIL((5.0 * (ROW_NUMBER() OVER (ORDER BY {order}) - 1))"
        " / NULLIF(COUNT(*) OVER () - 1, 0))) AS INT)"
    )


def _growth_step(source: str, series: str = "") -> str:
    by = f"PARTITION BY {series} " if series else ""
    lag = "LAG(revenue, {n}) OVER (" + by + "ORDER BY month)"
    frame = "OVER (" + by + "ORDER BY month ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"

    def change(n: int) -> str:
        before = lag.format(n=n)
        return _rnd(_ratio(f"revenue - {before}", before) + " * 100.0", 2)

    def mean(n: int) -> str:
        f = frame.format(n=n)
        # whole cents, halves up: decimals divide into doubles here
        cents, rows = f"CAST(SUM(revenue) {f} * 100 AS HUGEINT)", f"COUNT(*) {f}"
        return f"(CAST((2 * {cents} + {rows}) // (2 * {rows}) AS DOUBLE) / 100.0)"

    return f"""
      SELECT *, {change(1)} AS mom_growth_pct, {change(12)} AS yoy_growth_pct,
             {mean(2)} AS revenue_ma3, {mean(5)} AS revenue_ma6,
             SUM(revenue) OVER ({by}ORDER BY month ROWS UNBOUNDED PRECEDING) AS cumulative_revenue,
             CAST(year(month) AS VARCHAR) || 'Q' || CAST(quarter(month) AS VARCHAR) AS quarter
      FROM {source}"""


STEPS = {
    "products": """
      SELECT p_partkey AS id, p_name AS name, p_type AS category,
             CAST(p_retailprice AS DECIMAL(18,2)) AS price,
             CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(40 + p_size AS DECIMAL(4,0))
                  * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS cost
      FROM part""",
    "customers": """
      SELECT c_custkey AS id, c_mktsegment AS segment, r_name AS region,
             CASE c_custkey % 3 WHEN 0 THEN 'Online' WHEN 1 THEN 'Store' ELSE 'B2B' END AS acquisition_channel
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "sales": """
      SELECT l_orderkey AS id, CAST(o_orderdate AS DATE) AS date, l_partkey AS product_id,
             o_custkey AS customer_id, CAST(l_quantity AS INT) AS quantity,
             CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                  AS DECIMAL(18,2)) AS revenue,
             k.region AS region,
             CASE o_orderstatus WHEN 'F' THEN 'Online' WHEN 'O' THEN 'Store' ELSE 'B2B' END AS channel
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customers k ON o_custkey = k.id""",
    "monthly": f"""
      SELECT {_MONTH} AS month, SUM(revenue) AS revenue, COUNT(*) AS orders,
             COUNT(DISTINCT customer_id) AS unique_customers
      FROM sales GROUP BY 1""",
    "growth": _growth_step("monthly"),
    "region_month": f"SELECT {_MONTH} AS month, region, SUM(revenue) AS revenue FROM sales GROUP BY 1, 2",
    "region_growth": _growth_step("region_month", "region"),
    "cells": """
      SELECT region, channel, SUM(revenue) AS revenue, COUNT(*) AS orders,
             COUNT(DISTINCT customer_id) AS unique_customers
      FROM sales GROUP BY 1, 2""",
    "product_stats": f"""
      SELECT p.id, p.name, p.category, p.price, p.cost, p.price - p.cost AS gross_profit_per_unit,
             {_MARGIN} AS margin_pct, SUM(s.revenue) AS total_revenue, SUM(s.quantity) AS total_units,
             COUNT(*) AS total_orders
      FROM products p JOIN sales s ON p.id = s.product_id
      GROUP BY p.id, p.name, p.category, p.price, p.cost""",
    "shares": f"""
      SELECT *, {_rnd(_ratio('total_revenue', 'SUM(total_revenue) OVER ()') + ' * 100.0', 2)} AS revenue_share_pct,
             {_rnd(_ratio('SUM(total_revenue) OVER (ORDER BY total_revenue DESC, id ROWS UNBOUNDED PRECEDING)',
                          'SUM(total_revenue) OVER ()'), 4)} AS cumulative_revenue_pct
      FROM product_stats""",
    "abc": """
      SELECT *, CASE WHEN cumulative_revenue_pct <= 0.80 THEN 'A' WHEN cumulative_revenue_pct <= 0.95 THEN 'B'
                     ELSE 'C' END AS abc_class
      FROM shares""",
    "halves": f"""
      SELECT p.id, p.name, p.category, p.price, p.cost,
             COALESCE(SUM(CASE WHEN month(s.date) <= 6 THEN s.revenue END), 0) AS h1_revenue,
             COALESCE(SUM(CASE WHEN month(s.date) > 6 THEN s.revenue END), 0) AS h2_revenue,
             SUM(s.revenue) AS total_revenue_year
      FROM sales s JOIN products p ON p.id = s.product_id
      WHERE year(s.date) = {YEAR} GROUP BY ALL""",
    "half_growth": f"""
      SELECT *, {_rnd(_ratio('h2_revenue - h1_revenue', 'h1_revenue') + ' * 100.0', 2)} AS growth_h1_to_h2
      FROM halves""",
    "medians": f"""
      SELECT median({_dbl('total_revenue_year')}) AS revenue_median, median(growth_h1_to_h2) AS growth_median
      FROM half_growth""",
    "bcg": f"""
      SELECT *, {_dbl('total_revenue_year')} >= revenue_median AS hi_rev,
             COALESCE(growth_h1_to_h2 >= growth_median, FALSE) AS hi_gro
      FROM half_growth CROSS JOIN medians""",
    "customer_stats": f"""
      SELECT s.customer_id, c.segment, c.region, c.acquisition_channel, COUNT(*) AS total_orders,
             SUM(s.revenue) AS total_revenue, {_ratio('SUM(s.revenue)', 'COUNT(*)')} AS avg_order_value,
             MIN(s.date) AS first_purchase, MAX(s.date) AS last_purchase,
             date_diff('day', MIN(s.date), MAX(s.date)) AS customer_lifespan_days
      FROM sales s JOIN customers c ON s.customer_id = c.id GROUP BY ALL""",
    "rfm_raw": """
      SELECT customer_id, date_diff('day', MAX(date), (SELECT MAX(date) FROM sales)) AS recency,
             COUNT(*) AS frequency, SUM(revenue) AS monetary
      FROM sales GROUP BY 1""",
    "rfm_scores": f"""
      SELECT r.customer_id, recency, frequency, monetary,
             CASE WHEN recency <= e[1] THEN 5 WHEN recency <= e[2] THEN 4 WHEN recency <= e[3] THEN 3
                  WHEN recency <= e[4] THEN 2 ELSE 1 END AS r_score,
             {_bin5('frequency, customer_id')} AS f_score, {_bin5('monetary, customer_id')} AS m_score
      FROM rfm_raw r CROSS JOIN (SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS e FROM rfm_raw) q""",
    "rfm": """
      SELECT *, r_score + f_score + m_score AS rfm_score,
             CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
                  WHEN r_score + f_score + m_score >= 10 AND r_score >= 3 THEN 'Loyal Customers'
                  WHEN r_score >= 4 AND f_score <= 2 THEN 'Recent Customers'
                  WHEN r_score + f_score + m_score >= 9 THEN 'Potential Loyalists'
                  WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                  WHEN r_score = 1 AND f_score >= 3 THEN 'Lost Champions'
                  ELSE 'Needs Attention' END AS rfm_segment
      FROM rfm_scores""",
    "clv_life": """
      SELECT *, GREATEST(customer_lifespan_days / 365.0, CAST(0.1 AS DOUBLE)) AS life FROM (
        SELECT customer_id, segment, total_orders, avg_order_value,
               CAST(customer_lifespan_days AS DOUBLE) AS customer_lifespan_days
        FROM customer_stats WHERE total_orders >= 2)""",
    "clv_each": f"SELECT *, {_rnd('avg_order_value * (total_orders / life) * life', 2)} AS clv FROM clv_life",
    "clv": f"SELECT *, {_rnd('clv / life', 2)} AS clv_year FROM clv_each",
    "churn": f"""
      SELECT customer_id, segment, total_revenue, total_orders, days,
             CASE WHEN days > 180 THEN CASE WHEN rich THEN 'critical' ELSE 'high' END
                  WHEN days > 90 THEN CASE WHEN rich THEN 'high' ELSE 'medium' END
                  WHEN days > 60 AND total_orders / seg_orders < 0.5 THEN 'medium' ELSE 'low' END AS churn_risk
      FROM (
        SELECT c.*, date_diff('day', last_purchase, (SELECT MAX(last_purchase) FROM customer_stats)) AS days,
               {_dbl('total_revenue')} > (SELECT {_avg('total_revenue')} FROM customer_stats) AS rich, g.seg_orders
        FROM customer_stats c
        LEFT JOIN (SELECT segment, {_avg('total_orders')} AS seg_orders FROM customer_stats GROUP BY 1) g
          ON c.segment = g.segment)""",
    "recent": f"""
      SELECT *, MAX(month) OVER () AS ref,
             CASE WHEN mom_growth_pct IS NOT NULL THEN
               ROW_NUMBER() OVER (ORDER BY mom_growth_pct IS NULL, month DESC) END AS mom_rank,
             CASE WHEN yoy_growth_pct IS NOT NULL THEN
               ROW_NUMBER() OVER (ORDER BY yoy_growth_pct IS NULL, month DESC) END AS yoy_rank
      FROM growth""",
    "kpi_months": f"""
      SELECT strftime(MIN(month), '%Y-%m') AS period_start, strftime(MAX(month), '%Y-%m') AS period_end,
             COUNT(*) AS period_total_months, strftime(MAX(ref), '%Y-%m-%d') AS period_reference_date,
             {_dbl('SUM(revenue)')} AS revenue_total,
             {_dbl("COALESCE(SUM(CASE WHEN month > ref - INTERVAL 12 MONTH THEN revenue END), 0)")} AS revenue_last_12_months,
             {_dbl("COALESCE(SUM(CASE WHEN month > ref - INTERVAL 24 MONTH AND month <= ref - INTERVAL 12 MONTH THEN revenue END), 0)")}
               AS revenue_prev_12_months,
             {_big('SUM(orders)')} AS revenue_total_orders,
             {_rnd(_avg('CASE WHEN mom_rank <= 6 THEN mom_growth_pct END'), 1)} AS growth_avg_mom_pct_last6m,
             {_rnd(_avg('CASE WHEN yoy_rank <= 3 THEN yoy_growth_pct END'), 1)} AS growth_avg_yoy_pct_last3m
      FROM recent""",
    "kpi_products": f"""
      SELECT {_rnd(_ratio('SUM(CAST(total_revenue AS DECIMAL(24,2)) * CAST(margin_pct AS DECIMAL(10,1)))', 'SUM(total_revenue)'), 1)}
               AS revenue_gross_margin_pct,
             COUNT(*) AS products_total_products,
             COUNT(*) FILTER (WHERE abc_class = 'A') AS products_a_class_count
      FROM abc""",
    "kpi_top": f"""
      SELECT name AS products_top_product_name, {_dbl('total_revenue')} AS products_top_product_revenue,
             margin_pct AS products_top_product_margin
      FROM abc ORDER BY total_revenue DESC, id LIMIT 1""",
    "kpi_worst": "SELECT name AS products_worst_product_name FROM abc ORDER BY total_revenue, id DESC LIMIT 1",
    "kpi_customers": f"""
      SELECT COUNT(DISTINCT customer_id) AS customers_active_total, {_rnd(_avg('total_revenue'), 2)} AS customers_avg_clv,
             {_rnd(_avg('avg_order_value'), 2)} AS revenue_avg_order_value
      FROM customer_stats""",
    "kpi_rfm": """
      SELECT COUNT(*) FILTER (WHERE rfm_segment = 'Champions') AS customers_champions_count,
             COUNT(*) FILTER (WHERE rfm_segment = 'At Risk') AS customers_at_risk_count
      FROM rfm""",
    "region_sums": "SELECT region, SUM(revenue) AS revenue FROM cells GROUP BY 1",
    "kpi_best": f"""
      SELECT region AS top_performers_best_region, {_dbl('revenue')} AS top_performers_best_region_revenue
      FROM region_sums ORDER BY revenue DESC, region LIMIT 1""",
    "kpi_least": f"""
      SELECT region AS top_performers_worst_region, {_dbl('revenue')} AS top_performers_worst_region_revenue
      FROM region_sums ORDER BY revenue, region LIMIT 1""",
    "kpi_channel": """
      SELECT channel AS top_performers_best_channel
      FROM (SELECT channel, SUM(revenue) AS revenue FROM cells GROUP BY 1) ORDER BY revenue DESC, channel LIMIT 1""",
    "kpi": f"""
      SELECT *,
             CASE WHEN revenue_prev_12_months > 0 THEN
               {_rnd(_ratio("CAST(revenue_last_12_months AS DECIMAL(28,2)) - CAST(revenue_prev_12_months AS DECIMAL(28,2))", 'revenue_prev_12_months') + ' * 100.0', 1)}
             END AS growth_yoy_pct,
             {_rnd(_ratio('customers_champions_count', 'customers_active_total') + ' * 100.0', 1)} AS customers_champions_pct
      FROM kpi_months CROSS JOIN kpi_products CROSS JOIN kpi_top CROSS JOIN kpi_worst CROSS JOIN kpi_customers
           CROSS JOIN kpi_rfm CROSS JOIN kpi_best CROSS JOIN kpi_least CROSS JOIN kpi_channel""",
}


def _euro(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE '€' || format('{{:>12}}', translate(format('{{:,.2f}}', {x}), ',.', '.,')) END"


def _pct(x: str, signed: bool = False) -> str:
    sign = f"CASE WHEN {x} > 0 THEN '+' ELSE '' END || " if signed else ""
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE {sign}format('{{:.1f}}%', {x}) END"


def _whole(x: str) -> str:
    return f"translate(format('{{:,}}', {x}), ',.', '.,')"


def _magnitude(x: str) -> str:
    return (
        f"CASE WHEN abs({x}) >= 1e6 THEN format('€{{:.1f}}M', {_rnd(f'{x} / 1e6', 1)})"
        f" WHEN abs({x}) >= 1e3 THEN format('€{{:.0f}}K', {_rnd(f'{x} / 1e3', 0)})"
        f" ELSE format('€{{:.0f}}', {_rnd(x, 0)}) END"
    )


_GROWTH_COLUMNS = f"""
    mom_growth_pct, yoy_growth_pct, revenue_ma3, revenue_ma6, {_dbl('cumulative_revenue')} AS cumulative_revenue, quarter"""

_MONTH_COLUMNS = f"""
    {_LABEL} AS month, {_int('year(month)')} AS year, {_int('month(month)')} AS month_num, {_dbl('revenue')} AS revenue,
    {_big('orders')} AS orders, {_big('unique_customers')} AS unique_customers,
    {_ratio('revenue', 'orders')} AS avg_order_value"""

_ABC_COLUMNS = f"""
    id, name, category, {_dbl('price')} AS price, {_dbl('cost')} AS cost,
    {_dbl('gross_profit_per_unit')} AS gross_profit_per_unit, margin_pct, {_dbl('total_revenue')} AS total_revenue,
    {_big('total_units')} AS total_units, {_big('total_orders')} AS total_orders,
    {_ratio('total_revenue', 'total_orders')} AS avg_order_revenue"""

# fixed values: what becomes a column in the test tables; the engine finds its columns by itself
_CHANNELS = ("B2B", "Online", "Store")
_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _columns(column: str, values: tuple[str, ...], cell: str) -> str:
    """One column per value; ``cell`` makes it from the sum of its cells."""
    return ",\n".join(f"""{cell.format(f"SUM(revenue) FILTER (WHERE {column} = '{value}')")} AS "{value}\"""" for value in values)


def _matrix(row_total: str, column_total: str) -> str:
    cell = _dbl("COALESCE({}, 0)")
    return f"""
      SELECT CASE WHEN GROUPING(region) = 1 THEN '{column_total}' ELSE region END AS region,
             {_columns("channel", _CHANNELS, cell)}, {cell.format("SUM(revenue)")} AS "{row_total}"
      FROM cells GROUP BY ROLLUP (region)"""


def _top(k: int) -> str:
    return f"""
      SELECT id, name, category, {_dbl('total_revenue')} AS total_revenue, margin_pct, abc_class
      FROM abc ORDER BY total_revenue DESC, id LIMIT {k}"""


_CALENDAR_BASE = f"""
    SELECT {_LABEL.replace('month', 'a.month')} AS month, a.region, {_dbl('a.revenue')} AS revenue,
           {_rnd(_ratio('a.revenue - b.revenue', 'b.revenue') + ' * 100.0', 2)} AS mom_growth_pct,
           {_rnd(_ratio('a.revenue - c.revenue', 'c.revenue') + ' * 100.0', 2)} AS yoy_growth_pct,
           a.revenue_ma3, a.revenue_ma6, {_dbl('a.cumulative_revenue')} AS cumulative_revenue, a.quarter
    FROM region_growth a
    LEFT JOIN region_month b ON b.region = a.region AND b.month = a.month - INTERVAL 1 MONTH
    LEFT JOIN region_month c ON c.region = a.region AND c.month = a.month - INTERVAL 12 MONTH"""

QUERIES = {
    "quarantined_sales": """
      SELECT reasons, COUNT(*) AS sales, CAST(SUM(quantity) AS BIGINT) AS units,
             CAST(SUM(COUNT(*)) OVER (PARTITION BY reasons = '') AS BIGINT) AS rows_of_part
      FROM (SELECT CASE WHEN product_id % 89 = 0 THEN 0 ELSE quantity END AS quantity,
                   concat_ws(', ', CASE WHEN id % 97 = 0 THEN 'unreadable date' END, CASE WHEN customer_id % 101 = 0 THEN 'missing region' END,
                             CASE WHEN product_id % 89 = 0 THEN 'quantity below 1' END) AS reasons
            FROM sales) GROUP BY reasons""",
    "monthly_revenue": f"SELECT {_MONTH_COLUMNS} FROM monthly ORDER BY 1",
    "daily_rollup_months": f"SELECT {_MONTH_COLUMNS} FROM monthly ORDER BY 1",
    "daily_rollup_buyers": """
      SELECT region, channel, COUNT(DISTINCT customer_id) AS unique_customers
      FROM sales WHERE date BETWEEN DATE '1997-03-10' AND DATE '1999-10-21' GROUP BY region, channel""",
    "quarterly_revenue": f"""
      SELECT {_int('year(date)')} AS year, 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter,
             {_dbl('SUM(revenue)')} AS revenue, COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS unique_customers
      FROM sales GROUP BY 1, 2 ORDER BY 1, 2""",
    "revenue_by_region_channel": f"""
      SELECT region, channel, {_dbl('revenue')} AS revenue, orders, {_ratio('revenue', 'orders')} AS avg_order_value,
             unique_customers
      FROM cells ORDER BY revenue DESC""",
    "revenue_by_region_month": f"SELECT {_LABEL} AS month, region, {_dbl('revenue')} AS revenue FROM region_month ORDER BY 1, 2",
    "top_products_revenue_margin": f"SELECT {_ABC_COLUMNS} FROM product_stats ORDER BY total_revenue DESC, id",
    "product_monthly_revenue": f"""
      SELECT strftime(s.date, '%Y-%m') AS month, p.category, p.name, {_dbl('SUM(s.revenue)')} AS revenue,
             {_big('SUM(s.quantity)')} AS units
      FROM sales s JOIN products p ON s.product_id = p.id GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    "category_revenue_share": f"""
      SELECT p.category, {_dbl('SUM(s.revenue)')} AS revenue, COUNT(*) AS orders,
             {_rnd(_dbl('SUM(s.revenue)') + ' * 100.0 / ' + _dbl('(SELECT SUM(revenue) FROM sales)'), 2)} AS revenue_share_pct
      FROM products p JOIN sales s ON p.id = s.product_id GROUP BY 1 ORDER BY 2 DESC""",
    "customer_lifetime_value": f"""
      SELECT customer_id, segment, region, acquisition_channel, total_orders, {_dbl('total_revenue')} AS total_revenue,
             avg_order_value, strftime(first_purchase, '%Y-%m-%d') AS first_purchase,
             strftime(last_purchase, '%Y-%m-%d') AS last_purchase,
             {_int('customer_lifespan_days')} AS customer_lifespan_days
      FROM customer_stats ORDER BY total_revenue DESC, customer_id""",
    "acquisition_channel_efficiency": f"""
      SELECT acquisition_channel, COUNT(DISTINCT customer_id) AS total_customers,
             {_ratio('SUM(total_revenue)', 'COUNT(*)')} AS avg_clv,
             {_ratio('SUM(total_orders)', 'COUNT(*)')} AS avg_orders_per_customer,
             {_dbl('SUM(total_revenue)')} AS total_revenue_from_channel
      FROM customer_stats GROUP BY 1 ORDER BY 3 DESC""",
    "raw_sales": f"""
      SELECT s.id, strftime(s.date, '%Y-%m-%d') AS date, s.customer_id, s.product_id, s.quantity,
             {_dbl('s.revenue')} AS revenue, s.region, s.channel, p.category, p.name AS product_name,
             {_dbl('p.price')} AS price, {_dbl('p.cost')} AS cost, c.segment, c.acquisition_channel
      FROM sales s JOIN products p ON s.product_id = p.id JOIN customers c ON s.customer_id = c.id""",
    "kpi_overview": f"""
      SELECT {_dbl('SUM(revenue)')} AS total_revenue, COUNT(*) AS total_orders,
             COUNT(DISTINCT customer_id) AS active_customers, {_rnd(_ratio('SUM(revenue)', 'COUNT(*)'), 2)} AS avg_order_value,
             {_big('SUM(quantity)')} AS total_units_sold, {_dbl('SUM(revenue - quantity * cost)')} AS gross_profit,
             {_rnd(_ratio('SUM(revenue - quantity * cost)', 'SUM(revenue)') + ' * 100.0', 1)} AS gross_margin_pct
      FROM sales s JOIN products p ON s.product_id = p.id""",
    "monthly_growth": f"SELECT {_MONTH_COLUMNS}, {_GROWTH_COLUMNS} FROM growth ORDER BY 1",
    "monthly_growth_by_region": f"""
      SELECT {_LABEL} AS month, region, {_dbl('revenue')} AS revenue, {_GROWTH_COLUMNS} FROM region_growth ORDER BY 2, 1""",
    "monthly_growth_calendar": _CALENDAR_BASE,
    "monthly_revenue_in_period": f"""
      SELECT {_MONTH_COLUMNS} FROM monthly WHERE month BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' ORDER BY 1""",
    "monthly_revenue_since": f"""
      SELECT {_MONTH_COLUMNS}
      FROM (SELECT {_MONTH} AS month, SUM(revenue) AS revenue, COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS unique_customers
            FROM sales WHERE date >= DATE '{SINCE}' GROUP BY 1)""",
    "loaded_tables": f"""
      SELECT channel, segment, category, {_dbl('SUM(revenue)')} AS revenue, {_big('SUM(quantity)')} AS units, COUNT(*) AS orders,
             strftime(MIN(date), '%Y-%m-%d') AS first_date
      FROM sales JOIN products ON product_id = products.id JOIN customers ON customer_id = customers.id GROUP BY 1, 2, 3""",
    "written_growth": f"SELECT {_MONTH_COLUMNS}, {_GROWTH_COLUMNS} FROM growth",
    "region_channel_in_period": f"""
      SELECT region, channel, {_dbl('SUM(revenue)')} AS revenue, COUNT(*) AS orders FROM sales
      WHERE date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' GROUP BY 1, 2 ORDER BY 1, 2""",
    "revenue_matrix": _matrix("total", "Total"),
    "abc_analysis": f"SELECT {_ABC_COLUMNS}, revenue_share_pct, cumulative_revenue_pct, abc_class FROM abc",
    "abc_summary": f"""
      SELECT abc_class, COUNT(*) AS products, {_dbl('SUM(total_revenue)')} AS revenue,
             {_rnd(_ratio('SUM(total_revenue)', '(SELECT SUM(total_revenue) FROM abc)') + ' * 100.0', 2)} AS revenue_share_pct
      FROM abc GROUP BY 1 ORDER BY 1""",
    "bcg_matrix": f"""
      SELECT id, name, category, {_dbl('h1_revenue')} AS h1_revenue, {_dbl('h2_revenue')} AS h2_revenue, growth_h1_to_h2,
             {_dbl('total_revenue_year')} AS total_revenue_year,
             CASE WHEN hi_rev AND hi_gro THEN 'Star' WHEN hi_rev THEN 'Cash Cow' WHEN hi_gro THEN 'Question Mark'
                  ELSE 'Dog' END AS bcg_quadrant
      FROM bcg""",
    "rfm": f"""
      SELECT customer_id, {_int('recency')} AS recency, frequency, {_dbl('monetary')} AS monetary, r_score, f_score, m_score,
             rfm_score, rfm_segment
      FROM rfm""",
    "clv_by_segment": f"""
      SELECT segment, {_rnd(_avg('clv'), 2)} AS avg_clv, {_rnd('median(clv)', 2)} AS median_clv,
             {_rnd(_avg('clv_year'), 2)} AS avg_annual_clv, {_rnd(_avg('total_orders'), 2)} AS avg_orders,
             {_rnd(_avg('avg_order_value'), 2)} AS avg_order_value, COUNT(*) AS customer_count
      FROM clv GROUP BY 1""",
    "churn_risk": f"""
      SELECT customer_id, segment, {_dbl('total_revenue')} AS total_revenue, total_orders,
             {_int('days')} AS days_since_last_purchase, churn_risk
      FROM churn""",
    "churn_distribution": "SELECT churn_risk, COUNT(*) AS customers FROM churn GROUP BY 1",
    "trend_signals": f"""
      SELECT {_dbl('arg_max(revenue, month)')} AS last_month_revenue,
             (SELECT {_rnd(_avg('mom_growth_pct'), 2)} FROM (SELECT * FROM growth ORDER BY month DESC LIMIT 3))
               AS avg_mom_pct_last3m,
             CASE WHEN (SELECT mom_growth_pct FROM recent WHERE mom_rank = 1)
                       > (SELECT mom_growth_pct FROM recent WHERE mom_rank = 3)
                  THEN 'accelerating' ELSE 'slowing' END AS mom_trend,
             (SELECT {_LABEL} FROM growth ORDER BY revenue DESC, month LIMIT 1) AS best_month,
             (SELECT {_LABEL} FROM growth ORDER BY revenue, month LIMIT 1) AS worst_month,
             {_rnd('stddev_samp(CAST(revenue AS DOUBLE)) / avg(CAST(revenue AS DOUBLE)) * 100', 1)} AS volatility_pct,
             {_ratio('SUM(revenue) FILTER (WHERE month(month) IN (10, 11, 12))', 'COUNT(*) FILTER (WHERE month(month) IN (10, 11, 12))')}
               > {_ratio('SUM(revenue)', 'COUNT(*)')} * CAST(1.2 AS DOUBLE) AS q4_boost
      FROM growth""",
    "top_bottom_months": f"""
      SELECT part, {_LABEL} AS month, strftime(month, '%B %Y') AS label, {_dbl('revenue')} AS revenue,
             {_magnitude(_dbl('revenue'))} AS revenue_short, mom_growth_pct
      FROM ((SELECT 'top' AS part, * FROM growth ORDER BY revenue DESC, month LIMIT 3)
            UNION ALL (SELECT 'flop' AS part, * FROM growth ORDER BY revenue, month DESC LIMIT 3))""",
    "top10_products": _top(10),
    "rfm_segment_share": f"""
      SELECT rfm_segment, COUNT(*) AS customers,
             {_rnd(_ratio('COUNT(*)', '(SELECT COUNT(*) FROM rfm)') + ' * 100.0', 1)} AS share_pct,
             {_dbl('SUM(monetary)')} AS revenue
      FROM rfm GROUP BY 1""",
    "monthly_export": f"SELECT {_MONTH_COLUMNS}, {_GROWTH_COLUMNS} FROM growth ORDER BY 1",
    "product_export": f"""
      SELECT name AS "Name", category AS "Category", {_dbl('price')} AS "Price", margin_pct AS "Margin Pct",
             {_dbl('total_revenue')} AS "Total Revenue", {_big('total_units')} AS "Total Units",
             {_big('total_orders')} AS "Total Orders", abc_class AS "Abc Class"
      FROM abc""",
    "region_matrix_export": _matrix("Gesamt", "GESAMT"),
    "rfm_segment_summary": f"""
      SELECT rfm_segment, COUNT(*) AS customers, {_rnd(_avg('monetary'), 2)} AS avg_revenue,
             {_rnd(_avg('frequency'), 2)} AS avg_orders, {_rnd(_avg('recency'), 2)} AS avg_recency_days,
             {_dbl('SUM(monetary)')} AS total_revenue
      FROM rfm GROUP BY 1""",
    "revenue_trend_forecast": f"""
      SELECT kind, {_int('idx')} AS idx, strftime(month, '%Y-%m') AS month, {_dbl('revenue')} AS revenue,
             {_rnd('intercept + slope * idx', 2)} AS trend
      FROM (SELECT 'fitted' AS kind, idx, month, revenue FROM numbered
            UNION ALL
            SELECT 'forecast', (SELECT MAX(idx) FROM numbered) + step,
                   CAST((SELECT MAX(month) FROM numbered) + to_months(CAST(step AS INT)) AS DATE), NULL
            FROM range(0, 4) AS steps(step)) CROSS JOIN line""",
    "region_month_heatmap": f"""
      SELECT {_LABEL} AS month, strftime(month, '%b %y') AS label, month(month) IN (10, 11, 12) AS fourth_quarter,
             {_columns("region", _REGIONS, _dbl("{}") + " / 1000.0")}
      FROM region_month GROUP BY month""",
    "product_matrix_points": f"""
      SELECT id, category, {_dbl('total_revenue_year')} AS total_revenue_year, growth_h1_to_h2, {_MARGIN} AS margin_pct,
             {_rnd('revenue_median', 2)} AS revenue_median, {_rnd('growth_median', 2)} AS growth_median,
             CASE WHEN {_dbl('total_revenue_year')} > revenue_median THEN
               CASE WHEN length(name) > 18 THEN substring(name, 1, 18) || '…' ELSE name END END AS label
      FROM bcg WHERE growth_h1_to_h2 IS NOT NULL""",
    "rfm_scatter_points": f"""
      SELECT customer_id, {_int('recency')} AS recency, {_dbl('monetary')} AS monetary, frequency, rfm_segment FROM rfm""",
    "dashboard_months": f"""
      SELECT {_LABEL.replace('month', 'g.month')} AS month, strftime(g.month, '%b %Y') AS label,
             {_dbl('g.revenue')} AS revenue, month(g.month) IN (10, 11, 12) AS fourth_quarter, revenue_ma3, revenue_ma6,
             {_rnd('intercept + slope * idx', 2)} AS trend
      FROM growth g JOIN numbered n ON g.month = n.month CROSS JOIN line""",
    "mom_bars": f"""
      SELECT {_LABEL} AS month, mom_growth_pct, mom_growth_pct >= 0 AS not_negative,
             (SELECT {_rnd(_avg('mom_growth_pct'), 2)} FROM growth) AS mean_mom_pct
      FROM growth WHERE mom_growth_pct IS NOT NULL""",
    "yoy_compare": f"""
      SELECT {_int('month(b.month)')} AS month_num, {_dbl('a.revenue')} AS revenue_before, {_dbl('b.revenue')} AS revenue,
             b.revenue >= a.revenue AS grew
      FROM monthly a JOIN monthly b ON month(a.month) = month(b.month)
      WHERE year(a.month) = {YEAR - 1} AND year(b.month) = {YEAR}""",
    "quarter_totals": f"SELECT quarter, {_dbl('SUM(revenue)')} AS revenue FROM growth GROUP BY 1 ORDER BY 1",
    "november_peak": f"""
      SELECT {_LABEL} AS month, {_dbl('revenue')} AS revenue FROM monthly
      WHERE month(monthly.month) = 11 ORDER BY monthly.revenue DESC, monthly.month LIMIT 1""",
    "prompt_top5_products": _top(5),
    "table_contract_check": f"""
      SELECT 'products' AS table_name, COUNT(*) AS row_count,
             {_big('SUM((id IS NULL)::INT + (name IS NULL)::INT + (category IS NULL)::INT + (price IS NULL)::INT + (cost IS NULL)::INT)')}
               AS missing_values,
             COUNT(*) - COUNT(DISTINCT id) AS repeated_ids, {_big('0')} AS unknown_products, {_big('0')} AS unknown_customers
      FROM products
      UNION ALL
      SELECT 'customers', COUNT(*),
             {_big('SUM((id IS NULL)::INT + (segment IS NULL)::INT + (region IS NULL)::INT + (acquisition_channel IS NULL)::INT)')},
             COUNT(*) - COUNT(DISTINCT id), 0, 0
      FROM customers
      UNION ALL
      SELECT 'sales', COUNT(*),
             {_big('SUM((id IS NULL)::INT + (date IS NULL)::INT + (product_id IS NULL)::INT + (customer_id IS NULL)::INT + (quantity IS NULL)::INT + (revenue IS NULL)::INT + (region IS NULL)::INT + (channel IS NULL)::INT)')},
             CAST(NULL AS BIGINT),
             (SELECT COUNT(*) FROM sales WHERE product_id NOT IN (SELECT id FROM products)),
             (SELECT COUNT(*) FROM sales WHERE customer_id NOT IN (SELECT id FROM customers))
      FROM sales""",
    "safe_pct_change": f"""
      SELECT quarter, {_dbl('revenue')} AS revenue,
             {_rnd(_ratio('revenue - before', 'ABS(before)') + ' * 100.0', 2)} AS change_pct
      FROM (SELECT *, LAG(revenue) OVER (ORDER BY quarter) AS before
            FROM (SELECT quarter, SUM(revenue) AS revenue FROM growth GROUP BY 1))""",
    "upper_titles": f"SELECT upper(region) AS heading, {_dbl('SUM(revenue)')} AS revenue FROM cells GROUP BY 1",
    "distinct_dimension_values": """
      SELECT DISTINCT 'region' AS dimension, region AS value FROM cells
      UNION ALL SELECT DISTINCT 'channel', channel FROM cells
      UNION ALL SELECT DISTINCT 'category', category FROM products
      UNION ALL SELECT DISTINCT 'segment', segment FROM customers
      UNION ALL SELECT DISTINCT 'acquisition_channel', acquisition_channel FROM customers""",
    "kpis": f"""
      SELECT period_start, period_end, {_big('period_total_months')} AS period_total_months, period_reference_date,
             revenue_total, revenue_last_12_months, revenue_prev_12_months, revenue_total_orders, revenue_gross_margin_pct,
             revenue_avg_order_value, growth_yoy_pct, growth_avg_mom_pct_last6m, growth_avg_yoy_pct_last3m,
             products_total_products, products_a_class_count, products_top_product_name, products_top_product_revenue,
             products_top_product_margin, products_worst_product_name, customers_active_total, customers_avg_clv,
             customers_champions_count, customers_at_risk_count, customers_champions_pct, top_performers_best_region,
             top_performers_worst_region, top_performers_best_channel, top_performers_best_region_revenue,
             top_performers_worst_region_revenue
      FROM kpi""",
    "kpi_display": f"""
      SELECT {_euro('revenue_total')} AS total_revenue, {_euro('revenue_last_12_months')} AS revenue_12m,
             {_pct('growth_yoy_pct', True)} AS yoy_growth, {_pct('growth_avg_mom_pct_last6m', True)} AS mom_growth_avg,
             {_pct('revenue_gross_margin_pct')} AS gross_margin, {_euro('revenue_avg_order_value')} AS avg_order_value,
             {_whole('customers_active_total')} AS active_customers, {_pct('customers_champions_pct')} AS champions_pct,
             top_performers_best_region AS best_region, top_performers_worst_region AS worst_region,
             top_performers_best_channel AS best_channel, products_top_product_name AS top_product
      FROM kpi""",
    "kpi_table": "SELECT 1 AS position, 'Total revenue' AS kpi, revenue_total AS value, CAST(NULL AS VARCHAR) AS text,"
    " '€' AS unit, period_start || ' – ' || period_end AS period FROM kpi"
    + "".join(
        f" UNION ALL SELECT {i}, '{kpi}', {value}, {text}, '{unit}', '{period}' FROM kpi"
        for i, kpi, value, text, unit, period in [
            (2, "Revenue (last 12 months)", "revenue_last_12_months", "NULL", "€", "last 12 months"),
            (3, "Revenue (12 months before)", "revenue_prev_12_months", "NULL", "€", "12 months before"),
            (4, "YoY growth", "growth_yoy_pct", "NULL", "%", "YoY"),
            (5, "Mean MoM growth", "growth_avg_mom_pct_last6m", "NULL", "%", "last 6 months"),
            (6, "Gross margin", "revenue_gross_margin_pct", "NULL", "%", "weighted"),
            (7, "Orders", "revenue_total_orders", "NULL", "orders", "total"),
            (8, "Active customers", "customers_active_total", "NULL", "customers", "total"),
            (9, "Mean order value", "revenue_avg_order_value", "NULL", "€", "mean"),
            (10, "Champions", "customers_champions_count", "NULL", "customers", "current"),
            (11, "At risk", "customers_at_risk_count", "NULL", "customers", "current"),
            (12, "Best region", "NULL", "top_performers_best_region", "", ""),
            (13, "Worst region", "NULL", "top_performers_worst_region", "", ""),
            (14, "Best channel", "NULL", "top_performers_best_channel", "", ""),
            (15, "Top product", "NULL", "products_top_product_name", "", ""),
        ]
    ),
    "dashboard_cards": f"""
      SELECT 1 AS card, 'TOTAL REVENUE' AS title, format('€{{:.2f}}M', {_rnd('revenue_total / 1e6', 2)}) AS value,
             CASE WHEN growth_yoy_pct IS NULL THEN '' ELSE {_pct('growth_yoy_pct', True)} || ' YoY' END AS sub,
             COALESCE(growth_yoy_pct > 0, FALSE) AS positive FROM kpi
      UNION ALL
      SELECT 2, 'Ø MOM GROWTH',
             CASE WHEN growth_avg_mom_pct_last6m IS NULL THEN 'N/A' ELSE format('{{:+.1f}}%', growth_avg_mom_pct_last6m) END,
             'Last 6 months', COALESCE(growth_avg_mom_pct_last6m > 0, FALSE) FROM kpi
      UNION ALL
      SELECT 3, 'GROSS MARGIN', {_pct('revenue_gross_margin_pct')}, 'Weighted mean margin', TRUE FROM kpi
      UNION ALL
      SELECT 4, 'ACTIVE CUSTOMERS', {_whole('customers_active_total')}, {_pct('customers_champions_pct')} || ' Champions', TRUE
      FROM kpi""",
    "insight_facts": f"""
      SELECT CASE WHEN COALESCE(growth_yoy_pct, 0) > 10 THEN 'strong' WHEN COALESCE(growth_yoy_pct, 0) > 0 THEN 'moderate'
                  ELSE 'declining' END AS growth_rating,
             CASE WHEN COALESCE(revenue_gross_margin_pct, 0) > 30 THEN 'healthy' ELSE 'pressured' END AS margin_rating,
             {_rnd('top_performers_best_region_revenue - top_performers_worst_region_revenue', 2)} AS region_gap,
             {_rnd('(top_performers_best_region_revenue - top_performers_worst_region_revenue) / GREATEST(top_performers_worst_region_revenue, 1) * 100', 0)}
               AS region_gap_pct,
             {_rnd('customers_at_risk_count * COALESCE(revenue_avg_order_value, 100) * CAST(0.2 AS DOUBLE)', 2)} AS recovery_potential,
             {_dbl("ROUND(CAST(revenue_total AS DECIMAL(28,2)) * CAST(1.1 AS DECIMAL(2,1)), 2)")} AS outlook_revenue
      FROM kpi""",
}

STEPS["numbered"] = "SELECT ROW_NUMBER() OVER (ORDER BY month) - 1 AS idx, month, revenue FROM monthly"
STEPS["line"] = f"""
      SELECT regr_slope({_dbl('revenue')}, {_dbl('idx')}) AS slope, regr_intercept({_dbl('revenue')}, {_dbl('idx')}) AS intercept
      FROM numbered"""


def _read_by(text: str) -> list[str]:
    words = set(re.findall(r"\b(?:FROM|JOIN)\s+\(*\s*(\w+)", text))
    return [step for step in STEPS if step in words]


def _needed(text: str, seen: list[str]) -> list[str]:
    for step in _read_by(text):
        if step not in seen:
            _needed(STEPS[step], seen)
            if step not in seen:
                seen.append(step)
    return seen


def oracle() -> dict[str, str]:
    """One self-contained SQL string per registered query."""
    out = {}
    for name, final in QUERIES.items():
        ctes = ",\n".join(f"{step} AS ({STEPS[step]})" for step in _needed(final, []))
        out[name] = f"WITH {ctes}\n{final}"
    return out
