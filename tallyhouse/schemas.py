"""Fixed table schemas of the three layers. Nothing is ever inferred.

Text lengths live in the field metadata (`max_length`); keys and required
columns are listed below the schemas, as parquet enforces none of them.
Surrogate keys and log counters are BIGINT, so they hold at any table size.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _text(name: str, length: int = 50) -> T.StructField:
    return T.StructField(name, T.StringType(), True, {"max_length": length})


def _cols(names: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


def _int(names: str) -> list[T.StructField]:
    return _cols(names, T.IntegerType())


def _big(names: str) -> list[T.StructField]:
    return _cols(names, T.LongType())


def _date(names: str) -> list[T.StructField]:
    return _cols(names, T.DateType())


def _time(names: str) -> list[T.StructField]:
    return _cols(names, T.TimestampType())


def _money(names: str) -> list[T.StructField]:
    return _cols(names, MONEY)


def _flag(names: str) -> list[T.StructField]:
    return _cols(names, T.BooleanType())


# --- fixed values: table and column names, types and text lengths ---------

BRONZE = {
    "crm_cust_info": T.StructType(
        _int("cst_id")
        + [_text("cst_key"), _text("cst_firstname"), _text("cst_lastname")]
        + [_text("cst_marital_status"), _text("cst_gndr")]
        + _date("cst_create_date")
    ),
    "crm_prd_info": T.StructType(
        _int("prd_id")
        + [_text("prd_key"), _text("prd_nm")]
        + _int("prd_cost")
        + [_text("prd_line")]
        + _time("prd_start_dt prd_end_dt")
    ),
    "crm_sales_details": T.StructType(
        [_text("sls_ord_num"), _text("sls_prd_key")]
        + _int("sls_cust_id sls_order_dt sls_ship_dt sls_due_dt")
        + _int("sls_sales sls_quantity sls_price")
    ),
    "erp_loc_a101": T.StructType([_text("cid"), _text("cntry")]),
    "erp_cust_az12": T.StructType([_text("cid")] + _date("bdate") + [_text("gen")]),
    "erp_px_cat_g1v2": T.StructType(
        [_text("id"), _text("cat"), _text("subcat"), _text("maintenance")]
    ),
}

_AUDIT = _time("dwh_create_date")

SILVER = {
    "crm_cust_info": T.StructType(BRONZE["crm_cust_info"].fields + _AUDIT),
    "crm_prd_info": T.StructType(
        _int("prd_id")
        + [_text("cat_id"), _text("prd_key"), _text("prd_nm")]
        + _int("prd_cost")
        + [_text("prd_line")]
        + _date("prd_start_dt prd_end_dt")
        + _AUDIT
    ),
    "crm_sales_details": T.StructType(
        [_text("sls_ord_num"), _text("sls_prd_key")]
        + _int("sls_cust_id")
        + _date("sls_order_dt sls_ship_dt sls_due_dt")
        + _int("sls_sales sls_quantity sls_price")
        + _AUDIT
    ),
    "erp_loc_a101": T.StructType(BRONZE["erp_loc_a101"].fields + _AUDIT),
    "erp_cust_az12": T.StructType(BRONZE["erp_cust_az12"].fields + _AUDIT),
    "erp_px_cat_g1v2": T.StructType(BRONZE["erp_px_cat_g1v2"].fields + _AUDIT),
}

_HISTORY = _date("scd_start_date scd_end_date") + _flag("scd_is_current")
_STAMPS = _time("dw_insert_date dw_update_date")

GOLD = {
    "dim_customers": T.StructType(
        _big("customer_key")
        + _int("customer_id")
        + [_text("customer_number"), _text("first_name"), _text("last_name")]
        + [_text("country"), _text("marital_status", 20), _text("gender", 10)]
        + _date("birthdate create_date")
        + _HISTORY
        + _STAMPS
    ),
    "dim_products": T.StructType(
        _big("product_key")
        + _int("product_id")
        + [_text("product_number"), _text("product_name", 100)]
        + [_text("category_id"), _text("category"), _text("subcategory")]
        + [_text("maintenance")]
        + _money("cost")
        + [_text("product_line")]
        + _HISTORY
        + _STAMPS
    ),
    "dim_date": T.StructType(
        _date("date_key")
        + _int("year quarter month_number")
        + [_text("month_name", 10)]
        + _int("week_number day_of_week")
        + [_text("day_name", 10)]
        + _flag("is_weekend is_holiday")
    ),
    # product_number is kept beside the surrogate key: with the order number and
    # the number of the line among those of one product it is the merge key.
    "fact_sales": T.StructType(
        [_text("order_number"), _text("product_number")]
        + _int("line_number")
        + _big("product_key customer_key")
        + _date("date_key order_date shipping_date due_date")
        + _money("sales_amount")
        + _int("quantity")
        + _money("price")
        + _time("dw_insert_date")
    ),
    "dw_load_log": T.StructType(
        _big("log_id")
        + [_text("procedure_name", 128)]
        + _time("load_start load_end")
        + _big("rows_inserted rows_updated rows_expired")
        + [_text("status", 20), _text("error_message", 4000)]
    ),
}

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}

PRIMARY_KEYS = {
    "dim_customers": ["customer_key"],
    "dim_products": ["product_key"],
    "dim_date": ["date_key"],
    "fact_sales": ["order_number", "product_number", "line_number"],
    "dw_load_log": ["log_id"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("fact_sales", "product_key", "dim_products", "product_key"),
    ("fact_sales", "customer_key", "dim_customers", "customer_key"),
    ("fact_sales", "date_key", "dim_date", "date_key"),
]

REQUIRED = {
    "dim_customers": "customer_key customer_id customer_number scd_start_date "
    "scd_is_current dw_insert_date".split(),
    "dim_products": "product_key product_id product_number scd_start_date "
    "scd_is_current dw_insert_date".split(),
    "dim_date": [f.name for f in GOLD["dim_date"].fields],
    "fact_sales": "order_number product_number product_key customer_key date_key "
    "dw_insert_date".split(),
    "dw_load_log": "log_id procedure_name load_start status".split(),
}
