"""The two KPI reports as SQL over the tables by name, for persistent views.

They give the rows of `reports.report_customers` and `report_products` for a fact
whose keys are all resolved, as that of the loads is. Distinct counts come from
one grouping by (key, counted column) each, so no row is copied for them. The
dimension is joined without a broadcast, as a view cannot tell its rows from the
size of its files; the totals lie by its key already.
"""

from __future__ import annotations

import datetime as dt

from .analytics import VIP_MONTHS, VIP_SALES
from .reports import HIGH_SALES, MID_SALES


def _months(start: str, end: str) -> str:
    return f"(year({end}) - year({start})) * 12 + month({end}) - month({start})"


def _per(total: str, parts: str, without: str) -> str:
    """Total per part, `without` where there are no parts or, for a text of its own, no total."""
    return f"CASE WHEN {without} ELSE CAST({total} AS DOUBLE) / nullif(CAST({parts} AS DOUBLE), 0.0D) END"


def _totals(key: str, other: str, counted: str, sums: str = "", sums_again: str = "") -> str:
    """Orders, sums and order dates of each key, and how many of `other` it has."""
    return f"""sold AS (
  SELECT {key}, {other}, order_number, order_date, sales_amount, quantity
  FROM gold.fact_sales WHERE order_date IS NOT NULL),
orders AS (
  SELECT {key} AS sold_key, count(order_number) AS total_orders, sum(sales) AS total_sales,
         sum(pieces) AS total_quantity, min(first_day) AS first_order_date, max(last_day) AS last_order_date{sums_again}
  FROM (SELECT {key}, order_number, sum(sales_amount) AS sales, sum(quantity) AS pieces,
               min(order_date) AS first_day, max(order_date) AS last_day{sums}
        FROM sold GROUP BY {key}, order_number)
  GROUP BY {key}),
others AS (
  SELECT {key} AS other_key, count({other}) AS {counted}
  FROM (SELECT DISTINCT {key}, {other} FROM sold) GROUP BY {key}),
totals AS (
  SELECT *, {_months('first_order_date', 'last_order_date')} AS lifespan
  FROM orders JOIN others ON sold_key <=> other_key)"""


def _day(as_of: dt.date | None) -> str:
    return "current_date()" if as_of is None else f"DATE '{as_of.isoformat()}'"


def customers_sql(as_of: dt.date | None = None, vip_months: int = VIP_MONTHS, vip_sales: float = VIP_SALES) -> str:
    """`as_of` is the day ages and recency are counted to; without it, the day of reading."""
    today = _day(as_of)
    return f"""WITH {_totals('customer_key', 'product_key', 'total_products')},
people AS (
  SELECT /*+ MERGE(dim_customers) */ totals.*, customer_key, customer_number, year({today}) - year(birthdate) AS age,
         coalesce(concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')), ' ') AS customer_name
  FROM totals LEFT JOIN gold.dim_customers ON customer_key = sold_key)
SELECT customer_key, customer_number, customer_name, age,
  CASE WHEN age < 20 THEN 'Under 20' WHEN age < 50 THEN concat(age DIV 10 * 10, '-', age DIV 10 * 10 + 9)
       ELSE '50 and above' END AS age_group,
  CASE WHEN lifespan >= {vip_months} AND total_sales > {vip_sales} THEN 'VIP'
       WHEN lifespan >= {vip_months} AND total_sales <= {vip_sales} THEN 'Regular' ELSE 'New' END AS customer_segment,
  last_order_date, {_months('last_order_date', today)} AS recency,
  total_orders, total_sales, total_quantity, total_products, lifespan,
  {_per('total_sales', 'total_orders', 'total_sales = 0 THEN 0.0D')} AS avg_order_value,
  {_per('total_sales', 'lifespan', 'lifespan = 0 THEN CAST(total_sales AS DOUBLE)')} AS avg_monthly_spend
FROM people"""


def products_sql(as_of: dt.date | None = None, high_sales: float = HIGH_SALES, mid_sales: float = MID_SALES) -> str:
    """`as_of` is the day recency is counted to; without it, the day of reading."""
    price = "CAST(sales_amount AS DOUBLE) / nullif(CAST(quantity AS DOUBLE), 0.0D)"
    sums = f", sum({price}) AS price_part, count({price}) AS price_rows"
    again = ", round(sum(price_part) / nullif(CAST(sum(price_rows) AS DOUBLE), 0.0D), 1) AS avg_selling_price"
    return f"""WITH {_totals('product_key', 'customer_key', 'total_customers', sums, again)}
SELECT /*+ MERGE(dim_products) */ product_key, product_name, category, subcategory, cost, last_order_date AS last_sale_date,
  {_months('last_order_date', _day(as_of))} AS recency_in_months,
  CASE WHEN total_sales > {high_sales} THEN 'High-Performer' WHEN total_sales >= {mid_sales} THEN 'Mid-Range'
       ELSE 'Low-Performer' END AS product_segment,
  lifespan, total_orders, total_sales, total_quantity, total_customers, avg_selling_price,
  {_per('total_sales', 'total_orders', 'total_orders = 0 THEN 0.0D')} AS avg_order_revenue,
  {_per('total_sales', 'lifespan', 'lifespan = 0 THEN CAST(total_sales AS DOUBLE)')} AS avg_monthly_revenue
FROM totals LEFT JOIN gold.dim_products ON product_key = sold_key"""
