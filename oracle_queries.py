"""DuckDB SQL for every key of `queries()`, over the same driver tables.

Counts, years and keys are BIGINT and money is DOUBLE on both sides, so values
compare exactly. Sums are taken as DECIMAL before they become DOUBLE.
"""

from __future__ import annotations

import re

from tallyhouse.testviews import VIEWS

AS_OF = "DATE '2001-12-31'"

# Cleaned and staged tables, each over the views or over one another.
LAYERS = {
    "silver_cust_info": """
SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
       coalesce(map {'S': 'Single', 'M': 'Married'}[upper(trim(cst_marital_status))], 'n/a') AS cst_marital_status,
       coalesce(map {'F': 'Female', 'M': 'Male'}[upper(trim(cst_gndr))], 'n/a') AS cst_gndr,
       cst_create_date
FROM bronze_cust_info WHERE cst_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cst_id ORDER BY cst_create_date DESC) = 1
""",
    "silver_prd_info": """
SELECT prd_id, replace(left(prd_key, 5), '-', '_') AS cat_id, substr(prd_key, 7) AS prd_key, prd_nm,
       ifnull(prd_cost, 0) AS prd_cost,
       coalesce(map {'M': 'Mountain', 'R': 'Road', 'S': 'Other Sales', 'T': 'Touring'}[upper(trim(prd_line))], 'n/a') AS prd_line,
       CAST(prd_start_dt AS DATE) AS prd_start_dt,
       CAST(lead(prd_start_dt) OVER (PARTITION BY bronze_prd_info.prd_key ORDER BY prd_start_dt) AS DATE) - 1 AS prd_end_dt
FROM bronze_prd_info
""",
    "sales_parsed": """
SELECT *, CAST(try_strptime(if(length(CAST(sls_order_dt AS VARCHAR)) = 8, CAST(sls_order_dt AS VARCHAR), NULL), '%Y%m%d') AS DATE) AS order_day,
       CAST(try_strptime(if(length(CAST(sls_ship_dt AS VARCHAR)) = 8, CAST(sls_ship_dt AS VARCHAR), NULL), '%Y%m%d') AS DATE) AS ship_day,
       CAST(try_strptime(if(length(CAST(sls_due_dt AS VARCHAR)) = 8, CAST(sls_due_dt AS VARCHAR), NULL), '%Y%m%d') AS DATE) AS due_day,
       sls_quantity * abs(sls_price) AS expected
FROM {sales}
""",
    "silver_sales_details": """
SELECT sls_ord_num, sls_prd_key, sls_cust_id, order_day AS sls_order_dt, ship_day AS sls_ship_dt, due_day AS sls_due_dt,
       if(ifnull(sls_sales > 0, false) AND ifnull(sls_sales = expected, true), sls_sales, expected) AS sls_sales,
       sls_quantity,
       if(ifnull(sls_price > 0, false), sls_price, sls_sales // nullif(sls_quantity, 0)) AS sls_price
FROM sales_parsed
""",
    "silver_erp_cust": f"""
SELECT regexp_replace(cid, '^NAS', '') AS cid, if(bdate > {AS_OF}, NULL, bdate) AS bdate,
       coalesce(map {{'F': 'Female', 'FEMALE': 'Female', 'M': 'Male', 'MALE': 'Male'}}[upper(trim(gen))], 'n/a') AS gen
FROM bronze_erp_cust
""",
    "silver_erp_loc": """
SELECT replace(cid, '-', '') AS cid,
       coalesce(map {'DE': 'Germany', 'US': 'United States', 'USA': 'United States'}[trim(cntry)], nullif(trim(cntry), ''), 'n/a') AS cntry
FROM bronze_erp_loc
""",
    "stage_customers": """
SELECT cst_id AS customer_id, cst_key AS customer_number, nullif(cst_firstname, '') AS first_name,
       nullif(cst_lastname, '') AS last_name, nullif(cntry, 'n/a') AS country,
       nullif(cst_marital_status, 'n/a') AS marital_status,
       if(cst_gndr <> 'n/a', cst_gndr, ifnull(gen, 'n/a')) AS gender, bdate AS birthdate,
       cst_create_date AS create_date
FROM silver_cust_info LEFT JOIN silver_erp_cust AS e ON e.cid = cst_key LEFT JOIN silver_erp_loc AS l ON l.cid = cst_key
""",
    "stage_products": """
SELECT prd_id AS product_id, prd_key AS product_number, nullif(trim(prd_nm), '') AS product_name, cat_id AS category_id,
       cat AS category, subcat AS subcategory, maintenance, CAST(prd_cost AS DECIMAL(18,2)) AS cost,
       nullif(prd_line, 'n/a') AS product_line
FROM silver_prd_info LEFT JOIN bronze_erp_cat ON id = cat_id WHERE prd_end_dt IS NULL
""",
    "stage_sales": """
SELECT sls_ord_num AS order_number, sls_prd_key AS product_number, product_id AS product_key, customer_id AS customer_key,
       coalesce(sls_order_dt, sls_ship_dt, sls_due_dt) AS date_key, sls_order_dt AS order_date,
       sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
       sls_quantity AS quantity, sls_price AS price
FROM silver_sales_details LEFT JOIN stage_products ON product_number = sls_prd_key
LEFT JOIN stage_customers ON customer_id = sls_cust_id
""",
    "loadable": """
SELECT * FROM stage_sales WHERE product_key IS NOT NULL AND customer_key IS NOT NULL AND date_key IS NOT NULL
""",
    "merge_target": """
SELECT * REPLACE (if(order_no % 7 = 0, coalesce(price, 0) + 1, price) AS price,
                  if(order_no % 11 = 0, order_date - 1, order_date) AS order_date)
FROM (SELECT *, CAST(substr(order_number, 3) AS BIGINT) AS order_no FROM loadable) WHERE order_no % 5 <> 0
""",
    "merge_source": """
SELECT * FROM (SELECT *, CAST(substr(order_number, 3) AS BIGINT) AS order_no FROM loadable) WHERE order_no % 13 <> 0
""",
}


def delivered(name: str, day: int, changed: dict[str, str]) -> str:
    """A layer of one delivery: `changed` names what it leans on and the view of that day."""
    text = LAYERS[name]
    for old, new in changed.items():
        text = re.sub(rf"\b{old}\b" if old[0] != "{" else re.escape(old), new, text)
    return text


for _day in (1, 2):
    _names = ["sales_parsed", "silver_sales_details", "stage_sales"]
    _changed = {"{sales}": f"bronze_sales_day{_day}"} | {n: f"{n}_day{_day}" for n in _names}
    for _name in _names:
        LAYERS[f"{_name}_day{_day}"] = delivered(_name, _day, _changed)
    # lines are numbered before orphans go; lines of one order have one customer
    LAYERS[f"loadable_day{_day}"] = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number, product_number ORDER BY order_date NULLS FIRST,
  shipping_date NULLS FIRST, due_date NULLS FIRST, sales_amount NULLS FIRST, quantity NULLS FIRST, price NULLS FIRST) AS line_number
FROM stage_sales_day{_day}) WHERE product_key IS NOT NULL AND customer_key IS NOT NULL AND date_key IS NOT NULL
"""
LAYERS["second_load"] = """
SELECT t, s, s.order_number IS NOT NULL AND (t.order_number IS NULL
         OR (t.sales_amount, t.quantity, t.price) IS DISTINCT FROM (s.sales_amount, s.quantity, s.price)) AS changed
FROM loadable_day1 AS t FULL JOIN loadable_day2 AS s USING (order_number, product_number, line_number)
"""
LAYERS["second_fact"] = """
SELECT coalesce(t.order_number, s.order_number) AS order_number, unnest(struct_pack(
    customer_id := r.customer_key, product_id := r.product_key, order_date := r.order_date,
    sales_amount := r.sales_amount, quantity := r.quantity))
FROM (SELECT t, s, CASE WHEN changed THEN s ELSE t END AS r FROM second_load)
"""
for _day in (1, 2, 3):
    _changed = {
        "bronze_cust_info": f"bronze_cust_info_day{min(_day, 1)}" if _day == 1 else "bronze_cust_info",
        "bronze_erp_loc": "bronze_erp_loc" if _day == 1 else f"bronze_erp_loc_day{_day}",
        "bronze_prd_info": f"bronze_prd_info_day{_day}",
    }
    for _name in ("silver_cust_info", "silver_erp_loc", "stage_customers", "silver_prd_info", "stage_products"):
        _changed[_name] = f"{_name}_day{_day}"
        LAYERS[f"{_name}_day{_day}"] = delivered(_name, _day, _changed)


def versions(key: str, tracked: str, shown: str, expires: bool) -> str:
    """Versions over three deliveries on the first of a month: one starts where a member
    appears or a tracked column differs, and ends where the next starts or it is no longer sent."""
    gone = "c.day IS NULL" if expires else "false"
    return f"""SELECT {shown}, make_date(2001, CAST(a.day AS BIGINT), 1) AS scd_start_date,
       make_date(2001, CAST(ended AS BIGINT), 1) - 1 AS scd_end_date, ended IS NULL AS scd_is_current
FROM (
  SELECT a, (SELECT min(g.day) FROM (SELECT unnest([2, 3]) AS day) AS g
             LEFT JOIN sent AS c ON c.{key} = a.{key} AND c.day = g.day
             WHERE g.day > a.day AND ({gone} OR (c.day IS NOT NULL AND ({tracked.replace("@", "c")}) IS DISTINCT FROM ({tracked.replace("@", "a")})))) AS ended
  FROM sent AS a LEFT JOIN sent AS b ON b.{key} = a.{key} AND b.day = a.day - 1
  WHERE b.day IS NULL OR ({tracked.replace("@", "a")}) IS DISTINCT FROM ({tracked.replace("@", "b")}))"""


def sent(stage: str, body: str) -> str:
    days = " UNION ALL ".join(f"SELECT {n} AS day, * FROM {stage}_day{n}" for n in (1, 2, 3))
    return f"SELECT * FROM (WITH sent AS ({days}) {body})"


def query(body: str, sales: str = "bronze_sales_details") -> str:
    """`body` with a WITH clause for every view or layer it leans on."""
    known = {n: t.replace("{sales}", sales).strip() for n, t in {**VIEWS, **LAYERS}.items()}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name, definition in known.items():
            if name not in ordered and definition != text and re.search(rf"\b{name}\b", text):
                need(definition)
                ordered.append(name)

    need(body)
    clauses = ", ".join(f"{name} AS ({known[name]})" for name in ordered)
    return f"WITH {clauses} {body.strip()}" if clauses else body.strip()


def day_columns(day: str) -> str:
    return f"""CAST({day} AS DATE) AS date_key, year({day}) AS year, quarter({day}) AS quarter, month({day}) AS month_number,
       monthname({day}) AS month_name,
       (dayofyear({day}) - 1 + dayofweek(date_trunc('year', {day}))) // 7 + 1 AS week_number,
       dayofweek({day}) + 1 AS day_of_week, dayname({day}) AS day_name, dayofweek({day}) IN (0, 6) AS is_weekend,
       false AS is_holiday"""


TREND = """CAST(sum(sales_amount) AS DOUBLE) AS total_sales, count(DISTINCT customer_key) AS total_customers,
       CAST(sum(quantity) AS BIGINT) AS total_quantity FROM fact_sales WHERE order_date IS NOT NULL GROUP BY ALL"""
REVENUE = "CAST(sum(sales_amount) AS DOUBLE) AS total_revenue"
PRODUCTS = "fact_sales AS f LEFT JOIN dim_products AS p USING (product_key)"
BY_NAME = f"SELECT product_name, {REVENUE} FROM {PRODUCTS} GROUP BY product_name"
CUSTOMERS = "fact_sales AS f LEFT JOIN dim_customers AS c ON c.customer_key = f.customer_key"
DAYS = "SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS day"


def _silver(name: str, columns: str) -> str:
    return f"SELECT {columns} FROM {name}"


SALES_COLUMNS = """CAST(sls_cust_id AS BIGINT) AS sls_cust_id, sls_ord_num, sls_prd_key, sls_order_dt, sls_ship_dt, sls_due_dt,
       CAST(sls_sales AS BIGINT) AS sls_sales, CAST(sls_quantity AS BIGINT) AS sls_quantity,
       CAST(sls_price AS BIGINT) AS sls_price"""
STAGED_SALE = """order_number, product_number, CAST(product_key AS BIGINT) AS product_key,
       CAST(customer_key AS BIGINT) AS customer_key, date_key, order_date, shipping_date, due_date,
       CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(quantity AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS price"""

# Histories: expected versions follow from the key alone, one SELECT per class.
CUSTOMER_VERSION = """SELECT customer_id, {first} AS first_name, {country} AS country, gender,
       DATE '{start}' AS scd_start_date, CAST({end} AS DATE) AS scd_end_date, {end} IS NULL AS scd_is_current
FROM dim_customers WHERE {where}"""
PRODUCT_VERSION = """SELECT product_id, {category} AS category, {maintenance} AS maintenance, CAST(cost AS DOUBLE) AS cost,
       DATE '{start}' AS scd_start_date, CAST({end} AS DATE) AS scd_end_date, {end} IS NULL AS scd_is_current
FROM dim_products WHERE {where}"""
ENDED = "DATE '2001-01-31'"
OLD = {"category": "category", "maintenance": "maintenance"}
NEW = {
    "category": "if(product_key % 10 = 0, 'MOVED', category)",
    "maintenance": "if(product_key % 10 = 1, 'NEW', maintenance)",
}


def customer_history() -> str:
    new, moved = "customer_key % 97 = 1", "customer_key % 10 = 0"
    first = "if(customer_key % 10 = 1, 'NEWNAME', first_name)"
    rows = [
        dict(first=first, country=f"if({moved}, 'MOVED', country)", start="2001-02-01", end="NULL", where=new),
        dict(first="first_name", country="country", start="2001-01-01", end=ENDED, where=f"NOT {new} AND {moved}"),
        dict(first="first_name", country="'MOVED'", start="2001-02-01", end="NULL", where=f"NOT {new} AND {moved}"),
        dict(first="first_name", country="country", start="2001-01-01", end="NULL", where=f"NOT {new} AND NOT {moved}"),
    ]
    return " UNION ALL ".join(CUSTOMER_VERSION.format(**r) for r in rows)


def product_history() -> str:
    new, gone, moved = "product_key % 97 = 1", "product_key % 89 = 3", "product_key % 10 = 0"
    rows = [
        dict(OLD, start="2001-01-01", end="NULL", where=f"NOT {new} AND NOT {gone} AND NOT {moved}"),
        dict(OLD, start="2001-01-01", end=ENDED, where=f"NOT {new} AND ({gone} OR {moved})"),
        dict(NEW, start="2001-02-01", end="NULL", where=f"NOT {gone} AND ({new} OR {moved})"),
        dict(NEW, start="2001-03-01", end="NULL", where=gone),
    ]
    return " UNION ALL ".join(PRODUCT_VERSION.format(**r) for r in rows)


def log_rows() -> str:
    feeds = {
        "crm_cust_info": ("bronze_cust_info", "silver_cust_info"),
        "crm_prd_info": ("bronze_prd_info", "silver_prd_info"),
        "crm_sales_details": ("bronze_sales_details", "silver_sales_details"),
        "erp_cust_az12": ("bronze_erp_cust", "silver_erp_cust"),
        "erp_loc_a101": ("bronze_erp_loc", "silver_erp_loc"),
        "erp_px_cat_g1v2": ("bronze_erp_cat", "bronze_erp_cat"),
    }
    bad = " + ".join(
        f"count(*) FILTER (length(CAST(sls_{d}_dt AS VARCHAR)) = 8 AND {d}_day IS NULL)"
        for d in ("order", "ship", "due")
    )
    steps = [(f"bronze.{n}", f"(SELECT count(*) FROM {b})", "NULL") for n, (b, _) in feeds.items()]
    for n, (_, s) in feeds.items():
        note = "NULL"
        if n == "crm_sales_details":
            note = f"(SELECT if({bad} > 0, 'Dates set to NULL: ' || ({bad}), NULL) FROM sales_parsed)"
        steps.append((f"silver.{n}", f"(SELECT count(*) FROM {s})", note))
    orphans = "(SELECT count(*) FROM stage_sales) - (SELECT count(*) FROM loadable)"
    steps += [
        ("gold.load_dim_date", "DATE '2030-12-31' - DATE '2000-01-01' + 1", "NULL"),
        ("gold.load_dim_customers", "(SELECT count(*) FROM stage_customers)", "NULL"),
        ("gold.load_dim_products", "(SELECT count(*) FROM stage_products)", "NULL"),
        (
            "gold.load_fact_sales",
            "(SELECT count(*) FROM loadable)",
            f"if({orphans} > 0, 'Orphan rows skipped: ' || ({orphans}), NULL)",
        ),
    ]
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS log_id, '{name}' AS procedure_name, CAST({rows} AS BIGINT) AS rows_inserted, "
        f"CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_expired, 'SUCCESS' AS status, "
        f"CAST({note} AS VARCHAR) AS error_message"
        for i, (name, rows, note) in enumerate(steps, 1)
    )


def change_log() -> str:
    """The three steps of the second day's sales, after the sixteen of the first load."""
    bad = " + ".join(
        f"count(*) FILTER (length(CAST(sls_{d}_dt AS VARCHAR)) = 8 AND {d}_day IS NULL)" for d in ("order", "ship", "due")
    )
    lines = "(SELECT count(*) FROM bronze_sales_day2)"
    orphans = "(SELECT count(*) FROM stage_sales_day2) - (SELECT count(*) FROM loadable_day2)"
    added, changed = (
        f"(SELECT count(*) FROM second_load WHERE changed AND t.order_number IS {is_null} NULL)" for is_null in ("", "NOT")
    )
    steps = [
        ("bronze.crm_sales_details", lines, "0", "NULL"),
        ("silver.crm_sales_details", lines, "0",
         f"(SELECT if({bad} > 0, 'Dates set to NULL: ' || ({bad}), NULL) FROM sales_parsed_day2)"),
        ("gold.load_fact_sales", added, changed, f"if({orphans} > 0, 'Orphan rows skipped: ' || ({orphans}), NULL)"),
    ]
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS log_id, '{name}' AS procedure_name, CAST({rows} AS BIGINT) AS rows_inserted, "
        f"CAST({updates} AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_expired, 'SUCCESS' AS status, "
        f"CAST({note} AS VARCHAR) AS error_message"
        for i, (name, rows, updates, note) in enumerate(steps, 17)
    )


def column_rows() -> str:
    kinds = {
        "customer_key": "bigint",
        "customer_id": "bigint",
        "customer_number": "string",
        "first_name": "string",
        "last_name": "string",
        "country": "string",
        "marital_status": "string",
        "gender": "string",
        "birthdate": "date",
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS data_type, '{'NO' if c == 'gender' else 'YES'}' AS is_nullable, "
        f"CAST(NULL AS BIGINT) AS character_maximum_length, count(*) - count({c}) AS null_rows FROM dim_customers"
        for c, k in kinds.items()
    )


BODIES = {
    # cleaning
    "silver_cust_info": _silver(
        "silver_cust_info",
        "CAST(cst_id AS BIGINT) AS cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status, cst_gndr, cst_create_date",
    ),
    "silver_prd_info": _silver(
        "silver_prd_info",
        "CAST(prd_id AS BIGINT) AS prd_id, cat_id, prd_key, prd_nm, CAST(prd_cost AS BIGINT) AS prd_cost, prd_line, prd_start_dt, prd_end_dt",
    ),
    "silver_sales_details": _silver("silver_sales_details", SALES_COLUMNS),
    "silver_erp_cust": _silver("silver_erp_cust", "cid, bdate, gen"),
    "silver_erp_loc": _silver("silver_erp_loc", "cid, cntry"),
    "silver_erp_cat": _silver("bronze_erp_cat", "id, cat, subcat, maintenance"),
    "bronze_load": _silver("bronze_sales_details", SALES_COLUMNS.replace(
        "sls_order_dt, sls_ship_dt, sls_due_dt",
        "CAST(sls_order_dt AS BIGINT) AS sls_order_dt, CAST(sls_ship_dt AS BIGINT) AS sls_ship_dt, CAST(sls_due_dt AS BIGINT) AS sls_due_dt",
    )),
    # star schema
    "gold_dim_date": f"""SELECT {day_columns('day')} FROM ({DAYS} FROM
       (SELECT min(order_date) AS lo, greatest(max(order_date), max(shipping_date)) AS hi FROM fact_sales))""",
    "gold_stage_customers": """SELECT CAST(customer_id AS BIGINT) AS customer_id, customer_number, first_name, last_name,
       country, marital_status, gender, birthdate, create_date FROM stage_customers""",
    "gold_scd_customers": customer_history(),
    "gold_stage_products": """SELECT CAST(product_id AS BIGINT) AS product_id, product_number, product_name, category_id,
       category, subcategory, maintenance, CAST(cost AS DOUBLE) AS cost, product_line FROM stage_products""",
    "gold_scd_products": product_history(),
    "gold_stage_sales": f"SELECT {STAGED_SALE} FROM stage_sales",
    "gold_orphans": f"""SELECT {STAGED_SALE} FROM stage_sales
       WHERE product_key IS NULL OR customer_key IS NULL OR date_key IS NULL""",
    "gold_date_backfill": f"""SELECT {day_columns('day')} FROM (
       {DAYS} FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM fact_sales)
       UNION SELECT CAST(shipping_date AS TIMESTAMP) FROM fact_sales WHERE shipping_date IS NOT NULL)""",
    "gold_surrogate_keys": """SELECT sls_ord_num, sls_prd_key,
       row_number() OVER (ORDER BY sls_ord_num, sls_prd_key) + 100 AS sale_key FROM bronze_sales_unique""",
    "gold_fact_merge": """SELECT coalesce(t.order_number, s.order_number) AS order_number,
       coalesce(t.product_number, s.product_number) AS product_number,
       CAST(if(changed, s.sales_amount, t.sales_amount) AS DOUBLE) AS sales_amount,
       CAST(if(changed, s.quantity, t.quantity) AS BIGINT) AS quantity,
       CAST(if(changed, s.price, t.price) AS DOUBLE) AS price,
       if(changed, s.order_date, t.order_date) AS order_date,
       CASE WHEN t.order_number IS NULL THEN 'insert' WHEN changed THEN 'update' ELSE 'keep' END AS merge_action
       FROM (SELECT t, s, s.order_number IS NOT NULL AND (t.order_number IS NULL
               OR (t.sales_amount, t.quantity, t.price) IS DISTINCT FROM (s.sales_amount, s.quantity, s.price)) AS changed
             FROM merge_target AS t FULL JOIN merge_source AS s USING (order_number, product_number))""",
    "gold_load_all": """SELECT order_number, product_number, CAST(customer_key AS BIGINT) AS customer_id,
       CAST(product_key AS BIGINT) AS product_id, date_key, order_date, CAST(sales_amount AS DOUBLE) AS sales_amount,
       CAST(quantity AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS price FROM loadable""",
    "gold_second_load": """SELECT order_number, product_number, CAST(row.customer_key AS BIGINT) AS customer_id,
       CAST(row.product_key AS BIGINT) AS product_id, row.date_key, row.order_date, CAST(row.sales_amount AS DOUBLE) AS sales_amount,
       CAST(row.quantity AS BIGINT) AS quantity, CAST(row.price AS DOUBLE) AS price
       FROM (SELECT coalesce(t.order_number, s.order_number) AS order_number, coalesce(t.product_number, s.product_number) AS product_number,
                    CASE WHEN changed THEN s ELSE t END AS row FROM second_load)""",
    "gold_repeat_load": """SELECT order_number, product_number, CAST(customer_key AS BIGINT) AS customer_id,
       CAST(product_key AS BIGINT) AS product_id, date_key, order_date, CAST(sales_amount AS DOUBLE) AS sales_amount,
       CAST(quantity AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS price, CAST(0 AS BIGINT) AS new_batches FROM loadable""",
    "gold_second_dim_customers": sent("stage_customers", versions(
        "customer_id", "@.country, @.marital_status, @.gender",
        "CAST(a.customer_id AS BIGINT) AS customer_id, a.first_name, a.country, a.marital_status, a.gender, a.birthdate", False)),
    "gold_second_dim_products": sent("stage_products", versions(
        "product_id", "@.product_name, @.cost, @.product_line, @.category, @.subcategory",
        "CAST(a.product_id AS BIGINT) AS product_id, a.product_number, a.category, CAST(a.cost AS DOUBLE) AS cost, a.product_line", True)),
    # exploration
    "eda_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'VIEW' AS table_type, count(*) AS table_rows FROM {t}"
        for t in ("dim_customers", "dim_products", "fact_sales")
    ),
    "eda_columns": column_rows(),
    "eda_countries": "SELECT DISTINCT country FROM dim_customers ORDER BY 1 NULLS FIRST",
    "eda_product_tree": "SELECT DISTINCT category, subcategory, product_name FROM dim_products",
    "eda_order_range": """SELECT min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       date_diff('month', min(order_date), max(order_date)) AS order_range_months FROM fact_sales""",
    "eda_age_range": f"""SELECT min(birthdate) AS oldest_birthdate, date_diff('year', min(birthdate), {AS_OF}) AS oldest_age,
       max(birthdate) AS youngest_birthdate, date_diff('year', max(birthdate), {AS_OF}) AS youngest_age FROM dim_customers""",
    "eda_total_sales": "SELECT CAST(sum(sales_amount) AS DOUBLE) AS total_sales FROM fact_sales",
    "eda_total_quantity": "SELECT CAST(sum(quantity) AS BIGINT) AS total_quantity FROM fact_sales",
    "eda_avg_price": "SELECT CAST(sum(price) AS DOUBLE) / count(price) AS avg_price FROM fact_sales",
    "eda_order_rows": "SELECT count(order_number) AS total_orders FROM fact_sales",
    "eda_orders": "SELECT count(DISTINCT order_number) AS total_orders FROM fact_sales",
    "eda_products": "SELECT count(product_name) AS total_products FROM dim_products",
    "eda_customers": "SELECT count(customer_key) AS total_customers FROM dim_customers",
    "eda_buying_customers": "SELECT count(DISTINCT customer_key) AS total_customers FROM fact_sales",
    "eda_key_metrics": """SELECT unnest(['Total Sales', 'Total Quantity', 'Average Price', 'Total Orders', 'Total Products',
       'Total Customers']) AS measure_name, unnest([sales, quantity, price, orders, products, customers]) AS measure_value
       FROM (SELECT CAST(sum(sales_amount) AS DOUBLE) AS sales, CAST(sum(quantity) AS DOUBLE) AS quantity,
               CAST(sum(price) AS DOUBLE) / count(price) AS price, CAST(count(DISTINCT order_number) AS DOUBLE) AS orders,
               (SELECT CAST(count(DISTINCT product_name) AS DOUBLE) FROM dim_products) AS products,
               (SELECT CAST(count(customer_key) AS DOUBLE) FROM dim_customers) AS customers FROM fact_sales)""",
    "mag_customers_by_country": "SELECT country, count(customer_key) AS total_customers FROM dim_customers GROUP BY country",
    "mag_customers_by_gender": "SELECT gender, count(customer_key) AS total_customers FROM dim_customers GROUP BY gender",
    "mag_products_by_category": "SELECT category, count(product_key) AS total_products FROM dim_products GROUP BY category",
    "mag_avg_cost_by_category": """SELECT category, CAST(sum(cost) AS DOUBLE) / count(cost) AS avg_cost
       FROM dim_products GROUP BY category""",
    "mag_revenue_by_category": f"SELECT category, {REVENUE} FROM {PRODUCTS} GROUP BY category",
    "mag_revenue_by_customer": f"SELECT c.customer_key, first_name, last_name, {REVENUE} FROM {CUSTOMERS} GROUP BY ALL",
    "mag_items_by_country": f"""SELECT country, CAST(sum(quantity) AS BIGINT) AS total_sold_items
       FROM {CUSTOMERS} GROUP BY country""",
    "rank_top5_products": f"{BY_NAME} ORDER BY total_revenue DESC, product_name NULLS FIRST LIMIT 5",
    "rank_top5_products_window": f"""SELECT *, rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS rank_products
       FROM ({BY_NAME}) QUALIFY rank_products <= 5""",
    "rank_bottom5_products": f"{BY_NAME} ORDER BY total_revenue, product_name NULLS FIRST LIMIT 5",
    "rank_top10_customers": f"""SELECT c.customer_key, first_name, last_name, {REVENUE} FROM {CUSTOMERS} GROUP BY ALL
       ORDER BY total_revenue DESC, c.customer_key NULLS FIRST LIMIT 10""",
    "rank_bottom3_customers": f"""SELECT c.customer_key, first_name, last_name, count(DISTINCT order_number) AS total_orders
       FROM {CUSTOMERS} GROUP BY ALL ORDER BY total_orders, c.customer_key NULLS FIRST LIMIT 3""",
    # trends and segments
    "trend_year_month": f"SELECT year(order_date) AS order_year, month(order_date) AS order_month, {TREND}",
    "trend_month_trunc": f"SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_period, {TREND}",
    "trend_month_label": f"SELECT strftime(order_date, '%Y-%b') AS order_label, {TREND}",
    "cumulative_sales": """SELECT order_period, CAST(total AS DOUBLE) AS total_sales,
       CAST(sum(total) OVER w AS DOUBLE) AS running_total_sales,
       sum(price) OVER w / count(price) OVER w AS moving_average_price
       FROM (SELECT CAST(date_trunc('year', order_date) AS DATE) AS order_period, sum(sales_amount) AS total,
               CAST(sum(price) AS DOUBLE) / count(price) AS price FROM fact_sales WHERE order_date IS NOT NULL GROUP BY 1)
       WINDOW w AS (ORDER BY order_period NULLS FIRST)""",
    "performance_yoy": f"""SELECT order_year, product_name, CAST(sales AS DOUBLE) AS current_sales, own_mean AS avg_sales,
       CAST(sales AS DOUBLE) - own_mean AS diff_avg,
       ['Below Avg', 'Avg', 'Above Avg'][CAST(sign(CAST(sales AS DOUBLE) - own_mean) AS INT) + 2] AS avg_change,
       CAST(before AS DOUBLE) AS py_sales, CAST(sales - before AS DOUBLE) AS diff_py,
       ['Decrease', 'No Change', 'Increase'][CAST(ifnull(sign(sales - before), 0) AS INT) + 2] AS py_change
       FROM (SELECT *, CAST(sum(sales) OVER p AS DOUBLE) / count(sales) OVER p AS own_mean,
               lag(sales) OVER (PARTITION BY product_name ORDER BY order_year NULLS FIRST) AS before
             FROM (SELECT year(order_date) AS order_year, product_name, sum(sales_amount) AS sales
                   FROM {PRODUCTS} WHERE order_date IS NOT NULL GROUP BY ALL)
             WINDOW p AS (PARTITION BY product_name))""",
    "segment_products_by_cost": """SELECT CASE WHEN cost < 100 THEN 'Below 100' WHEN cost <= 500 THEN '100-500'
       WHEN cost <= 1000 THEN '500-1000' ELSE 'Above 1000' END AS cost_range, count(product_key) AS total_products
       FROM dim_products GROUP BY 1""",
    "segment_customers": f"""SELECT CASE WHEN months >= 36 AND spent > 2000000 THEN 'VIP'
       WHEN months >= 36 AND spent IS NOT NULL THEN 'Regular' ELSE 'New' END AS customer_segment,
       count(customer_key) AS total_customers
       FROM (SELECT c.customer_key, sum(sales_amount) AS spent, date_diff('month', min(order_date), max(order_date)) AS months
             FROM {CUSTOMERS} GROUP BY c.customer_key) GROUP BY 1""",
    "part_to_whole": f"""SELECT category, CAST(total AS DOUBLE) AS total_sales,
       CAST(sum(total) OVER () AS DOUBLE) AS overall_sales,
       round(CAST(total AS DOUBLE) / CAST(sum(total) OVER () AS DOUBLE) * 100, 2) AS percentage_of_total
       FROM (SELECT category, sum(sales_amount) AS total FROM {PRODUCTS} GROUP BY category)""",
    "report_customers": f"""SELECT customer_key, customer_number, customer_name, age,
       CASE WHEN age < 20 THEN 'Under 20' WHEN age < 50 THEN (age // 10 * 10) || '-' || (age // 10 * 10 + 9)
            ELSE '50 and above' END AS age_group,
       CASE WHEN lifespan >= 36 AND sales > 2000000 THEN 'VIP' WHEN lifespan >= 36 AND sales IS NOT NULL THEN 'Regular'
            ELSE 'New' END AS customer_segment,
       last_order_date, date_diff('month', last_order_date, {AS_OF}) AS recency, total_orders,
       CAST(sales AS DOUBLE) AS total_sales, total_quantity, total_products, lifespan,
       if(sales = 0, 0, CAST(sales AS DOUBLE) / total_orders) AS avg_order_value,
       if(lifespan = 0, CAST(sales AS DOUBLE), CAST(sales AS DOUBLE) / lifespan) AS avg_monthly_spend
       FROM (SELECT c.customer_key, customer_number, ifnull(first_name, '') || ' ' || ifnull(last_name, '') AS customer_name,
               date_diff('year', birthdate, {AS_OF}) AS age, count(DISTINCT order_number) AS total_orders,
               sum(sales_amount) AS sales, CAST(sum(quantity) AS BIGINT) AS total_quantity,
               count(DISTINCT product_key) AS total_products, max(order_date) AS last_order_date,
               date_diff('month', min(order_date), max(order_date)) AS lifespan
             FROM {CUSTOMERS} WHERE order_date IS NOT NULL GROUP BY ALL)""",
    "report_products": f"""SELECT product_key, product_name, category, subcategory, CAST(cost AS DOUBLE) AS cost, last_sale_date,
       date_diff('month', last_sale_date, {AS_OF}) AS recency_in_months,
       CASE WHEN sales > 1700000 THEN 'High-Performer' WHEN sales >= 1400000 THEN 'Mid-Range' ELSE 'Low-Performer' END AS product_segment,
       lifespan, total_orders, CAST(sales AS DOUBLE) AS total_sales, total_quantity, total_customers, avg_selling_price,
       if(total_orders = 0, 0, CAST(sales AS DOUBLE) / total_orders) AS avg_order_revenue,
       if(lifespan = 0, CAST(sales AS DOUBLE), CAST(sales AS DOUBLE) / lifespan) AS avg_monthly_revenue
       FROM (SELECT p.product_key, product_name, category, subcategory, cost, max(order_date) AS last_sale_date,
               date_diff('month', min(order_date), max(order_date)) AS lifespan, count(DISTINCT order_number) AS total_orders,
               count(DISTINCT customer_key) AS total_customers, sum(sales_amount) AS sales,
               CAST(sum(quantity) AS BIGINT) AS total_quantity,
               round(avg(CAST(sales_amount AS DOUBLE) / nullif(CAST(quantity AS DOUBLE), 0)), 1) AS avg_selling_price
             FROM fact_sales AS f LEFT JOIN dim_products AS p ON p.product_key = f.product_key
             WHERE order_date IS NOT NULL GROUP BY ALL)""",
    "report_view_customers": f"""SELECT customer_number, customer_name, age,
       CASE WHEN age < 20 THEN 'Under 20' WHEN age < 50 THEN (age // 10 * 10) || '-' || (age // 10 * 10 + 9)
            ELSE '50 and above' END AS age_group,
       CASE WHEN lifespan >= 36 AND sales > 2000000 THEN 'VIP' WHEN lifespan >= 36 AND sales IS NOT NULL THEN 'Regular'
            ELSE 'New' END AS customer_segment,
       last_order_date, date_diff('month', last_order_date, {AS_OF}) AS recency, total_orders,
       CAST(sales AS DOUBLE) AS total_sales, total_quantity, total_products, lifespan,
       if(sales = 0, 0, CAST(sales AS DOUBLE) / total_orders) AS avg_order_value,
       if(lifespan = 0, CAST(sales AS DOUBLE), CAST(sales AS DOUBLE) / lifespan) AS avg_monthly_spend
       FROM (SELECT customer_id, customer_number, ifnull(first_name, '') || ' ' || ifnull(last_name, '') AS customer_name,
               date_diff('year', birthdate, {AS_OF}) AS age, count(DISTINCT order_number) AS total_orders,
               sum(sales_amount) AS sales, CAST(sum(quantity) AS BIGINT) AS total_quantity,
               count(DISTINCT product_id) AS total_products, max(order_date) AS last_order_date,
               date_diff('month', min(order_date), max(order_date)) AS lifespan
             FROM second_fact JOIN stage_customers USING (customer_id) WHERE order_date IS NOT NULL GROUP BY ALL)""",
    "report_view_products": f"""SELECT product_name, category, subcategory, CAST(cost AS DOUBLE) AS cost, last_sale_date,
       date_diff('month', last_sale_date, {AS_OF}) AS recency_in_months,
       CASE WHEN sales > 1700000 THEN 'High-Performer' WHEN sales >= 1400000 THEN 'Mid-Range' ELSE 'Low-Performer' END AS product_segment,
       lifespan, total_orders, CAST(sales AS DOUBLE) AS total_sales, total_quantity, total_customers, avg_selling_price,
       if(total_orders = 0, 0, CAST(sales AS DOUBLE) / total_orders) AS avg_order_revenue,
       if(lifespan = 0, CAST(sales AS DOUBLE), CAST(sales AS DOUBLE) / lifespan) AS avg_monthly_revenue
       FROM (SELECT product_id, product_name, category, subcategory, cost, max(order_date) AS last_sale_date,
               date_diff('month', min(order_date), max(order_date)) AS lifespan, count(DISTINCT order_number) AS total_orders,
               count(DISTINCT customer_id) AS total_customers, sum(sales_amount) AS sales,
               CAST(sum(quantity) AS BIGINT) AS total_quantity,
               round(avg(CAST(sales_amount AS DOUBLE) / nullif(CAST(quantity AS DOUBLE), 0)), 1) AS avg_selling_price
             FROM second_fact JOIN stage_products USING (product_id) WHERE order_date IS NOT NULL GROUP BY ALL)""",
    # checks
    "dq_row_counts": """SELECT 'dim_date' AS tbl, max(order_date) - min(order_date) + 1 AS n FROM fact_sales
       UNION ALL SELECT 'dim_customers', count(*) FROM dim_customers
       UNION ALL SELECT 'dim_products', count(*) FROM dim_products
       UNION ALL SELECT 'fact_sales', count(*) FROM fact_sales""",
    "dq_layer_durations": f"""SELECT layer, count(*) AS steps,
       -- two looks at the clock a step, and one each inside the two gold steps that stamp rows after the first
       2 * count(*) - 1 + if(layer = 'gold', 2, 0) AS layer_seconds, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted
       FROM (SELECT split_part(procedure_name, '.', 1) AS layer, rows_inserted FROM ({log_rows()})) GROUP BY layer""",
    "dq_load_log_tail": log_rows(),
    "dq_load_log_changes": change_log(),
    "dq_orphan_customers": "SELECT count(*) AS unresolved_customers FROM stage_sales WHERE customer_key IS NULL",
    "dq_scd_current_unique": """SELECT CAST(cst_id AS BIGINT) AS customer_id, count(*) AS cnt FROM bronze_cust_info
       GROUP BY cst_id HAVING count(*) > 1""",
    "dq_primary_key": """SELECT 'fact_sales' AS table_name, order_number || '|' || product_key AS key_text, count(*) AS row_count
       FROM fact_sales GROUP BY order_number, product_key HAVING count(*) > 1""",
    "dq_foreign_key": """SELECT 'fact_sales' AS table_name, 'product_key' AS column_name, CAST(product_key AS VARCHAR) AS key_text,
       count(*) AS row_count FROM fact_sales WHERE product_key NOT IN (SELECT p_partkey FROM part) GROUP BY product_key
       UNION ALL SELECT 'fact_sales', 'date_key', CAST(ifnull(order_date, shipping_date) AS VARCHAR), count(*) FROM fact_sales
       WHERE ifnull(order_date, shipping_date) > (SELECT max(order_date) FROM fact_sales)
          OR ifnull(order_date, shipping_date) < (SELECT min(order_date) FROM fact_sales)
       GROUP BY ifnull(order_date, shipping_date)""",
    "dq_not_null": """SELECT * FROM (
       SELECT 'fact_sales' AS table_name, 'product_key' AS column_name, count(*) - count(product_key) AS null_rows FROM stage_sales
       UNION ALL SELECT 'fact_sales', 'customer_key', count(*) - count(customer_key) FROM stage_sales
       UNION ALL SELECT 'fact_sales', 'date_key', count(*) - count(date_key) FROM stage_sales
       UNION ALL SELECT 'dim_customers', 'customer_id', count(*) - count(cst_id) FROM bronze_cust_info) WHERE null_rows > 0
       UNION ALL SELECT t, c, CAST(NULL AS BIGINT) FROM (VALUES ('fact_sales', 'dw_insert_date'), ('dim_customers', 'customer_key'),
          ('dim_customers', 'customer_number'), ('dim_customers', 'scd_start_date'), ('dim_customers', 'scd_is_current'),
          ('dim_customers', 'dw_insert_date'), ('dim_products', 'scd_start_date'), ('dim_products', 'scd_is_current'),
          ('dim_products', 'dw_insert_date')) AS absent(t, c)""",
    "dq_layer_tables": " UNION ALL ".join(
        f"SELECT 'bronze' AS table_schema, '{t}' AS table_name, count(*) AS table_rows FROM {v}"
        for t, v in (
            ("crm_cust_info", "bronze_cust_info"),
            ("crm_prd_info", "bronze_prd_info"),
            ("crm_sales_details", "bronze_sales_details"),
            ("erp_cust_az12", "bronze_erp_cust"),
            ("erp_loc_a101", "bronze_erp_loc"),
            ("erp_px_cat_g1v2", "bronze_erp_cat"),
        )
    ),
    "dq_rejected_rows": """SELECT count(*) AS lines_read,
       count(*) FILTER (sls_quantity % 7 = 3) AS rejected, count(*) FILTER (sls_quantity % 7 = 3) AS rebuilt FROM bronze_sales_details""",
    "dq_bad_dates": " UNION ALL ".join(
        f"SELECT 'sls_{d}_dt' AS column_name, count(*) FILTER (length(CAST(sls_{d}_dt AS VARCHAR)) = 8 AND {d}_day IS NULL) AS bad_rows FROM sales_parsed"
        for d in ("order", "ship", "due")
    ),
    "dq_scd_ranges": """SELECT customer_id, DATE '2001-01-01' AS scd_start_date, DATE '2000-12-31' AS scd_end_date,
       false AS scd_is_current FROM dim_customers WHERE customer_key % 10 = 0 AND customer_key % 97 <> 1""",
}

UNIQUE_SALES = {"gold_surrogate_keys", "gold_fact_merge"}


def oracle() -> dict[str, str]:
    return {
        key: query(body, "bronze_sales_unique" if key in UNIQUE_SALES else "bronze_sales_details")
        for key, body in BODIES.items()
    }
