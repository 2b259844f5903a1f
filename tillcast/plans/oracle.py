"""DuckDB twins of the registered queries (same names, same output specs).

The driver registers the star-schema tables as views; each twin rebuilds the
retail shapes with CTEs and computes the same result in plain SQL.
"""

from __future__ import annotations

from tillcast.functions.holidays import holiday_sql
from tillcast.plans.spec import wrap_sql

# --- retail shapes over the driver tables ----------------------------------
SALES = """
sales AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date,
         printf('store_%03d', CAST(s.s_nationkey AS BIGINT)) AS store_id,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         p.p_brand AS category,
         CAST(l.l_quantity AS BIGINT) AS quantity_sold,
         p.p_retailprice AS unit_price,
         l.l_discount AS discount_percent,
         l.l_extendedprice * (1 - l.l_discount) AS revenue,
         0.7 * l.l_extendedprice AS cost,
         l.l_extendedprice * (1 - l.l_discount) - 0.7 * l.l_extendedprice AS profit
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
                  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

PROMOTIONS = """
promotions AS (
  SELECT l_shipdate AS date, CAST(l_partkey AS VARCHAR) AS product_id,
         'markdown' AS promotion_type, l_discount AS discount_percent
  FROM lineitem WHERE l_discount >= 0.08
)"""

TRAFFIC = f"""
traffic AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date,
         printf('store_%03d', CAST(c.c_nationkey AS BIGINT)) AS store_id,
         CAST(1 AS BIGINT) AS customer_traffic, 1.0 AS weather_impact,
         {holiday_sql("CAST(o.o_orderdate AS DATE)")} AS is_holiday
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

DAILY = """
daily AS (
  SELECT date, store_id, product_id, category,
         coalesce(sum(quantity_sold), 0) AS quantity_sold,
         coalesce(sum(revenue), 0) AS total_revenue,
         coalesce(sum(cost), 0) AS cost,
         avg(discount_percent) AS discount_percent,
         coalesce(sum(profit), 0) AS profit,
         avg(unit_price) AS unit_price
  FROM sales
  WHERE date IS NOT NULL AND store_id IS NOT NULL AND product_id IS NOT NULL AND category IS NOT NULL
  GROUP BY date, store_id, product_id, category
)"""

PROMO_SUMMARY = """
promo_summary AS (
  SELECT CAST(date AS DATE) AS date, product_id, max(discount_percent) AS discount_percent, 1 AS has_discount
  FROM promotions WHERE date IS NOT NULL AND product_id IS NOT NULL
  GROUP BY 1, 2
)"""

TRAFFIC_SUMMARY = """
traffic_summary AS (
  SELECT CAST(date AS DATE) AS date, store_id,
         coalesce(sum(customer_traffic), 0) AS customer_traffic,
         max(CAST(is_holiday AS INTEGER)) AS is_holiday
  FROM traffic WHERE date IS NOT NULL AND store_id IS NOT NULL
  GROUP BY 1, 2
)"""

# product-grain path exactly as described: join, fill with median, then roll up
STORE_DAILY = """
dp AS (
  SELECT d.*, CAST(coalesce(p.has_discount, 0) AS DOUBLE) AS has_discount
  FROM daily d LEFT JOIN promo_summary p ON d.date = p.date AND d.product_id = p.product_id
),
dpt AS (
  SELECT dp.*, t.customer_traffic, t.is_holiday
  FROM dp LEFT JOIN traffic_summary t ON dp.date = t.date AND dp.store_id = t.store_id
),
filled AS (
  SELECT * REPLACE (coalesce(CAST(customer_traffic AS DOUBLE),
                             (SELECT quantile_cont(customer_traffic, 0.5) FROM dpt)) AS customer_traffic)
  FROM dpt
),
store_daily AS (
  SELECT date, store_id, avg(has_discount) AS has_discount,
         round(coalesce(sum(total_revenue), 0) * 10000.0) / 10000.0 AS total_revenue,
         CAST(coalesce(sum(quantity_sold), 0) AS DOUBLE) AS quantity_sold,
         round(coalesce(sum(profit), 0) * 10000.0) / 10000.0 AS profit,
         max(customer_traffic) AS customer_traffic,
         CAST(max(is_holiday) AS INTEGER) AS is_holiday
  FROM filled GROUP BY date, store_id
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = with_ctes(SALES, PROMOTIONS, TRAFFIC, DAILY, PROMO_SUMMARY, TRAFFIC_SUMMARY, STORE_DAILY)

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


sql("store_daily", BASE + "\nSELECT * FROM store_daily")
sql("daily_product_sales", with_ctes(SALES, DAILY) + "\nSELECT * FROM daily")
sql(
    "daily_product_totals",
    with_ctes(SALES)
    + """
SELECT date, store_id, product_id, category,
       coalesce(sum(quantity_sold), 0) AS total_quantity,
       coalesce(sum(revenue), 0) AS total_revenue,
       coalesce(sum(cost), 0) AS total_cost,
       coalesce(sum(profit), 0) AS total_profit,
       max(CAST(discount_percent > 0 AS INTEGER)) AS has_discount
FROM sales
WHERE date IS NOT NULL AND store_id IS NOT NULL AND product_id IS NOT NULL AND category IS NOT NULL
GROUP BY date, store_id, product_id, category""",
)
sql("promotion_summary", with_ctes(PROMOTIONS, PROMO_SUMMARY) + "\nSELECT * FROM promo_summary")
sql(
    "sales_with_promotions",
    with_ctes(SALES, PROMOTIONS, DAILY, PROMO_SUMMARY)
    + """
SELECT d.date, d.store_id, d.product_id, d.category, d.total_revenue,
       CAST(coalesce(p.has_discount, 0) AS DOUBLE) AS has_discount
FROM daily d LEFT JOIN promo_summary p ON d.date = p.date AND d.product_id = p.product_id""",
)
sql("traffic_summary", with_ctes(TRAFFIC, TRAFFIC_SUMMARY) + "\nSELECT * FROM traffic_summary")
sql(
    "sales_with_traffic",
    with_ctes(SALES, TRAFFIC, DAILY, TRAFFIC_SUMMARY)
    + """,
j AS (
  SELECT d.date, d.store_id, d.product_id, d.total_revenue, t.customer_traffic
  FROM daily d LEFT JOIN traffic_summary t ON d.date = t.date AND d.store_id = t.store_id
)
SELECT date, store_id, product_id, total_revenue,
       coalesce(CAST(customer_traffic AS DOUBLE), (SELECT quantile_cont(customer_traffic, 0.5) FROM j)) AS customer_traffic,
       customer_traffic IS NULL AS traffic_was_missing
FROM j""",
)
sql(
    "dataset_profile",
    with_ctes(SALES, PROMOTIONS, TRAFFIC)
    + """
SELECT 'sales' AS dataset, count(*) AS rows, 10 AS columns FROM sales
UNION ALL SELECT 'promotions', count(*), 4 FROM promotions
UNION ALL SELECT 'customer_traffic', count(*), 5 FROM traffic
UNION ALL SELECT 'store_events', count(*), 5 FROM events WHERE event_type = 'error'""",
)


def oracle_sql(spec_of: dict[str, str]) -> dict[str, str]:
    return {name: wrap_sql(text, spec_of[name]) for name, text in ORACLE.items() if name in spec_of}
