"""Star tables and raw feeds derived from the driver's tables.

Plain SQL that Spark and DuckDB both run unchanged over `customer`, `nation`,
`part`, `orders` and `lineitem`, every table in full. The remainders below put
each kind of flaw into a share of the rows; no row is left out.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["customer", "nation", "part", "orders", "lineitem"]

VIEWS = {
    "dim_customers": """
SELECT c_custkey AS customer_key, c_custkey AS customer_id, c_name AS customer_number,
       split_part(c_name, '#', 1) AS first_name,
       CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
       n_name AS country,
       CASE c_custkey % 3 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' END AS marital_status,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Male'
            WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Female' ELSE 'n/a' END AS gender,
       CASE WHEN c_custkey % 50 = 0 THEN NULL
            ELSE DATE '1940-01-01' + CAST((c_custkey * 37) % 16000 AS INT) END AS birthdate
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "dim_products": """
SELECT p_partkey AS product_key, p_partkey AS product_id, CAST(p_partkey AS STRING) AS product_number,
       p_name AS product_name,
       CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_type END AS category,
       p_brand AS subcategory,
       CASE WHEN p_partkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS maintenance,
       CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE CAST(p_size * 25 AS DECIMAL(18,2)) END AS cost,
       CASE p_size % 4 WHEN 0 THEN 'Road' WHEN 1 THEN 'Mountain' WHEN 2 THEN 'Touring' END AS product_line
FROM part
""",
    "fact_sales": """
SELECT CAST(o_orderkey AS STRING) AS order_number,
       CASE WHEN l_orderkey % 211 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS product_key,
       o_custkey AS customer_key,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
       CAST(l_shipdate AS DATE) AS shipping_date,
       CAST(o_orderdate AS DATE) + 12 AS due_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS sales_amount,
       CAST(l_quantity AS INT) AS quantity,
       CAST(p_retailprice AS DECIMAL(18,2)) AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
""",
    "bronze_cust_info": """
SELECT c_custkey AS cst_id, c_name AS cst_key, '  ' || split_part(c_name, '#', 1) AS cst_firstname,
       split_part(c_name, '#', 2) || ' ' AS cst_lastname,
       CASE c_custkey % 5 WHEN 0 THEN 's ' WHEN 1 THEN ' M' WHEN 2 THEN 'X' WHEN 3 THEN NULL ELSE 'S' END AS cst_marital_status,
       CASE c_custkey % 4 WHEN 0 THEN ' f' WHEN 1 THEN 'M' WHEN 2 THEN '' END AS cst_gndr,
       DATE '2000-01-01' + CAST(c_custkey % 300 AS INT) AS cst_create_date
FROM customer
UNION ALL
SELECT c_custkey, c_name, split_part(c_name, '#', 1), split_part(c_name, '#', 2), 'M', 'F',
       DATE '2001-06-01' + CAST(c_custkey % 300 AS INT)
FROM customer WHERE c_custkey % 4 = 1
UNION ALL
SELECT NULL, c_name, 'ghost', 'row', 'S', 'M', DATE '2001-01-01' FROM customer WHERE c_custkey % 50 = 7
""",
    # one to three versions of each part
    "part_versions": """
SELECT p_partkey, p_name, p_size, 0 AS v FROM part
UNION ALL SELECT p_partkey, p_name, p_size, 1 AS v FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, p_name, p_size, 2 AS v FROM part WHERE p_partkey % 4 = 0
""",
    "bronze_prd_info": """
SELECT p_partkey * 10 + v AS prd_id,
       CASE p_partkey % 3 WHEN 0 THEN 'AC-HE-' WHEN 1 THEN 'BI-RB-' ELSE 'CO-PE-' END || 'P' || CAST(p_partkey AS STRING) AS prd_key,
       p_name AS prd_nm,
       CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE p_size * 25 + v END AS prd_cost,
       CASE p_partkey % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'r' WHEN 2 THEN ' S' WHEN 3 THEN 'T ' WHEN 4 THEN '' END AS prd_line,
       CAST(DATE '1995-07-01' + CAST(v * 366 AS INT) AS TIMESTAMP) AS prd_start_dt,
       CAST(DATE '1994-12-28' AS TIMESTAMP) AS prd_end_dt
FROM part_versions
""",
    "bronze_sales_details": """
SELECT 'SO' || CAST(l_orderkey AS STRING) AS sls_ord_num, 'P' || CAST(l_partkey AS STRING) AS sls_prd_key,
       CASE WHEN o_custkey % 83 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS sls_cust_id,
       CASE WHEN l_orderkey % 17 = 0 THEN 0 WHEN l_orderkey % 19 = 0 THEN 32154 WHEN l_orderkey % 307 = 0 THEN 20131332
            ELSE CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) END AS sls_order_dt,
       CASE WHEN l_orderkey % 34 = 0 THEN 0
            ELSE CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) END AS sls_ship_dt,
       CASE WHEN l_orderkey % 34 = 0 THEN NULL
            ELSE CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) END AS sls_due_dt,
       CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN -5 WHEN l_partkey % 31 = 0 THEN 99
            ELSE CAST(l_quantity * floor(l_extendedprice / l_quantity) AS INT) END AS sls_sales,
       CASE WHEN l_partkey % 29 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS sls_quantity,
       CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 23 = 0 THEN CAST(-floor(l_extendedprice / l_quantity) AS INT)
            ELSE CAST(floor(l_extendedprice / l_quantity) AS INT) END AS sls_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    # some numbers match no customer, so some customers have no partner row
    "bronze_erp_cust": """
SELECT CASE WHEN c_custkey % 20 = 3 THEN 'NASLOST' || c_name WHEN c_custkey % 2 = 0 THEN 'NAS' || c_name ELSE c_name END AS cid,
       CASE WHEN c_custkey % 45 = 0 THEN DATE '2050-01-01'
            ELSE DATE '1940-01-01' + CAST((c_custkey * 37) % 16000 AS INT) END AS bdate,
       CASE c_custkey % 6 WHEN 0 THEN 'F ' WHEN 1 THEN 'Male' WHEN 2 THEN ' female' WHEN 3 THEN 'm' WHEN 4 THEN '' END AS gen
FROM customer
""",
    "bronze_erp_loc": """
SELECT CASE WHEN c_custkey % 25 = 4 THEN 'LOST-' || c_name
            ELSE substring(c_name, 1, 3) || '-' || substring(c_name, 4) END AS cid,
       CASE c_custkey % 7 WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN ' USA' WHEN 3 THEN ' ' WHEN 4 THEN NULL ELSE ' ' || n_name || ' ' END AS cntry
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "bronze_erp_cat": """
SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN 'AC_HE' WHEN 1 THEN 'BI_RB' ELSE 'CO_PD' END AS id,
       CASE p_partkey % 3 WHEN 0 THEN 'Accessories' WHEN 1 THEN 'Bikes' ELSE 'Components' END AS cat,
       CASE p_partkey % 3 WHEN 0 THEN 'Helmets' WHEN 1 THEN 'Road Bikes' ELSE 'Pedals' END AS subcat,
       CASE p_partkey % 3 WHEN 2 THEN 'No' ELSE 'Yes' END AS maintenance
FROM part
""",
    # deliveries on several days: lines come late, change or are no longer sent
    "bronze_sales_day1": """
SELECT * FROM bronze_sales_details WHERE CAST(substring(sls_ord_num, 3) AS BIGINT) % 29 <> 3
""",
    "bronze_sales_day2": """
SELECT sls_ord_num, sls_prd_key, sls_cust_id,
       CASE WHEN CAST(substring(sls_ord_num, 3) AS BIGINT) % 11 = 0 THEN sls_ship_dt ELSE sls_order_dt END AS sls_order_dt,
       sls_ship_dt, sls_due_dt, sls_sales,
       CASE WHEN CAST(substring(sls_ord_num, 3) AS BIGINT) % 7 = 0 THEN sls_quantity + 1 ELSE sls_quantity END AS sls_quantity,
       sls_price
FROM bronze_sales_details WHERE CAST(substring(sls_ord_num, 3) AS BIGINT) % 31 <> 5
""",
    # customers: some are new on the second day, some move there and part of these back again
    "bronze_cust_info_day1": """
SELECT * FROM bronze_cust_info WHERE cst_id IS NULL OR cst_id % 97 <> 1
""",
    "bronze_erp_loc_day2": """
SELECT cid, CASE WHEN CAST(right(cid, 4) AS INT) % 10 = 0 THEN 'Iceland' ELSE cntry END AS cntry FROM bronze_erp_loc
""",
    "bronze_erp_loc_day3": """
SELECT cid, CASE WHEN CAST(right(cid, 4) AS INT) % 20 = 10 THEN 'Iceland' ELSE cntry END AS cntry FROM bronze_erp_loc
""",
    # products: some are new, some vanish on the second day and come back, some cost more from then on
    "bronze_prd_info_day1": """
SELECT * FROM bronze_prd_info WHERE floor(prd_id / 10) % 97 <> 1
""",
    "bronze_prd_info_day2": """
SELECT prd_id, prd_key, prd_nm, CASE WHEN floor(prd_id / 10) % 10 = 0 THEN prd_cost + 7 ELSE prd_cost END AS prd_cost,
       prd_line, prd_start_dt, prd_end_dt
FROM bronze_prd_info WHERE floor(prd_id / 10) % 89 <> 3
""",
    "bronze_prd_info_day3": """
SELECT prd_id, prd_key, prd_nm, CASE WHEN floor(prd_id / 10) % 10 = 0 THEN prd_cost + 7 ELSE prd_cost END AS prd_cost,
       prd_line, prd_start_dt, prd_end_dt
FROM bronze_prd_info
""",
    # one row per order and product
    "bronze_sales_unique": """
SELECT sls_ord_num, sls_prd_key, min(sls_cust_id) AS sls_cust_id, max(sls_order_dt) AS sls_order_dt,
       max(sls_ship_dt) AS sls_ship_dt, max(sls_due_dt) AS sls_due_dt, max(sls_sales) AS sls_sales,
       max(sls_quantity) AS sls_quantity, max(sls_price) AS sls_price
FROM bronze_sales_details GROUP BY sls_ord_num, sls_prd_key
""",
}


@cache
def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a view; its metadata is read once per session."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    words = set(re.findall(r"\w+", VIEWS[name]))
    register(spark, sf_dir, *[n for n in (*DRIVER_TABLES, *VIEWS) if n in words and n != name])
    return spark.sql(VIEWS[name])


def register(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Make tables and views readable by name in SQL."""
    for name in names:
        frame(spark, sf_dir, name).createOrReplaceTempView(name)
