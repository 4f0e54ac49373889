"""Star schema: calendar, staged dimension members, staged sales."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns
from ..functions.values import UNKNOWN, blank_to_null, unknown_to_null
from ..operators.merge import missing_rows
from ..operators.rows import number_in_group
from ..schemas import MONEY
from ..sources.feeds import split

# Default calendar range, tracked columns, merge columns.
CALENDAR_START, CALENDAR_END = dt.date(2000, 1, 1), dt.date(2030, 12, 31)
CUSTOMER_TRACKED = ["country", "marital_status", "gender"]
PRODUCT_TRACKED = ["product_name", "cost", "product_line", "category", "subcategory"]
FACT_KEYS = ["order_number", "product_number"]
LINE = "line_number"
FACT_COMPARE = ["sales_amount", "quantity", "price"]
FACT_SET = [
    "product_key",
    "customer_key",
    "date_key",
    "order_date",
    "shipping_date",
    "due_date",
    "sales_amount",
    "quantity",
    "price",
]
FACT_REFERENCES = ["product_key", "customer_key", "date_key"]


def build_dim_date(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """Every day from `start` to `end`, both included."""
    days = spark.range((end - start).days + 1)
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    return days.select(*calendar_columns(day))


def calendar_of(dates: DataFrame, column: str) -> DataFrame:
    """Every day between the first and the last date of a table."""
    ends = dates.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).filter("lo IS NOT NULL")
    days = ends.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.select(*calendar_columns(F.col("day")))


def missing_dates(dim_date: DataFrame, dates: DataFrame, column: str = "date_key") -> DataFrame:
    """Calendar rows for the dates of a table that the calendar lacks."""
    used = dates.select(F.col(column).alias("date_key")).filter("date_key IS NOT NULL").distinct()
    return missing_rows(dim_date, used, ["date_key"]).select(*calendar_columns(F.col("date_key")))


def backfill_dates(dim_date: DataFrame, dates: DataFrame, column: str = "date_key") -> DataFrame:
    return dim_date.unionByName(missing_dates(dim_date, dates, column))


def stage_customers(cust_info: DataFrame, erp_cust: DataFrame, erp_loc: DataFrame) -> DataFrame:
    """Customer members from three cleaned tables; the CRM gender goes first."""
    people = erp_cust.select(F.col("cid").alias("_cid"), "bdate", "gen")
    places = erp_loc.select(F.col("cid").alias("_loc_cid"), "cntry")
    joined = cust_info.join(people, F.col("cst_key") == F.col("_cid"), "left").join(
        places, F.col("cst_key") == F.col("_loc_cid"), "left"
    )
    gender = F.coalesce(
        unknown_to_null(F.col("cst_gndr")), unknown_to_null(F.col("gen")), F.lit(UNKNOWN)
    )
    return joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        blank_to_null(F.col("cst_firstname")).alias("first_name"),
        blank_to_null(F.col("cst_lastname")).alias("last_name"),
        unknown_to_null(F.col("cntry")).alias("country"),
        unknown_to_null(F.col("cst_marital_status")).alias("marital_status"),
        gender.alias("gender"),
        F.col("bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )


def stage_products(prd_info: DataFrame, erp_cat: DataFrame) -> DataFrame:
    """Product members: versions without an end, with their category."""
    groups = erp_cat.select(F.col("id").alias("_cat_id"), "cat", "subcat", "maintenance")
    active = prd_info.filter(F.col("prd_end_dt").isNull())
    joined = active.join(groups, F.col("cat_id") == F.col("_cat_id"), "left")
    return joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        blank_to_null(F.col("prd_nm")).alias("product_name"),
        F.col("cat_id").alias("category_id"),
        unknown_to_null(F.col("cat")).alias("category"),
        unknown_to_null(F.col("subcat")).alias("subcategory"),
        "maintenance",
        F.col("prd_cost").cast(MONEY).alias("cost"),
        unknown_to_null(F.col("prd_line")).alias("product_line"),
    )


def number_lines(sales: DataFrame) -> DataFrame:
    """Cleaned order lines with a number among the lines of one product in one order."""
    order = ["sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity", "sls_price", "sls_cust_id"]
    return number_in_group(sales, ["sls_ord_num", "sls_prd_key"], order, LINE)


def stage_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Order lines with the keys of the open dimension versions; line numbers are kept.

    The open versions are picked before the join, so only four narrow columns of
    the dimensions travel; Spark broadcasts them when their size allows and
    splits hot keys otherwise.
    """
    product = products.filter("scd_is_current").select("product_number", "product_key")
    customer = customers.filter("scd_is_current").select("customer_id", "customer_key")
    joined = sales.join(product, F.col("sls_prd_key") == F.col("product_number"), "left").join(
        customer, F.col("sls_cust_id") == F.col("customer_id"), "left"
    )
    return joined.select(
        F.col("sls_ord_num").alias("order_number"),
        F.col("sls_prd_key").alias("product_number"),
        *[c for c in sales.columns if c == LINE],
        "product_key",
        "customer_key",
        F.coalesce(*SALES_DATE_ORDER).alias("date_key"),
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").cast(MONEY).alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").cast(MONEY).alias("price"),
    )


SALES_DATE_ORDER = ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]


def is_orphan() -> Column:
    """A staged sale that lacks a product, a customer or a date."""
    product, customer, date = [F.col(c).isNull() for c in FACT_REFERENCES]
    return product | customer | date


def split_orphans(stage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sales that can be loaded, and the orphans."""
    return split(stage, is_orphan())
