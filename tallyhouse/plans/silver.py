"""Cleaning: one raw feed table in, one standardised table out."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import eight_digits, yyyymmdd
from ..functions.values import UNKNOWN, int_div, map_codes
from ..operators.rows import keep_latest, next_in_group
from ..schemas import SILVER

# Code labels.
MARITAL = {"S": "Single", "M": "Married"}
GENDER = {"F": "Female", "M": "Male"}
GENDER_WORDS = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}
CUSTOMER_PREFIX = "NAS"
SALES_DATES = ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]


def with_audit(df: DataFrame, table: str, now: dt.datetime) -> DataFrame:
    """Stamp the rows and put the columns in the order of the silver table."""
    return df.withColumn("dwh_create_date", F.lit(now)).select(*SILVER[table].names)


def clean_crm_cust_info(raw: DataFrame) -> DataFrame:
    """One row per customer, the newest; trimmed names, readable codes."""
    newest = keep_latest(raw.filter(F.col("cst_id").isNotNull()), ["cst_id"], "cst_create_date")
    return newest.withColumns(
        {
            "cst_firstname": F.trim("cst_firstname"),
            "cst_lastname": F.trim("cst_lastname"),
            "cst_marital_status": map_codes(F.col("cst_marital_status"), MARITAL),
            "cst_gndr": map_codes(F.col("cst_gndr"), GENDER),
        }
    )


def clean_crm_prd_info(raw: DataFrame) -> DataFrame:
    """Product versions with category and product key taken apart.

    A version ends the day before the next one of the same raw key starts; the
    end date in the feed is not used. The raw key is sequenced before it is cut.
    """
    sequenced = next_in_group(raw.drop("prd_end_dt"), ["prd_key"], "prd_start_dt", "_next")
    raw_key = F.col("prd_key")
    return sequenced.select(
        "prd_id",
        F.translate(F.substring(raw_key, 1, 5), "-", "_").alias("cat_id"),
        F.expr("substring(prd_key, 7)").alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        map_codes(F.col("prd_line"), PRODUCT_LINE).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        F.date_sub(F.col("_next").cast("date"), 1).alias("prd_end_dt"),
    )


def clean_crm_sales_details(raw: DataFrame) -> DataFrame:
    """Order lines with real dates, and amount and price repaired.

    Both repairs look at the raw values only: a wrong amount becomes quantity
    times absolute price, a missing or non-positive price the raw amount divided
    by the quantity, cut to a whole number.
    """
    amount, price = F.col("sls_sales"), F.col("sls_price")
    expected = expected_amount()
    amount_wrong = amount.isNull() | (amount <= 0) | (amount != expected)
    price_wrong = price.isNull() | (price <= 0)
    dates = {c: yyyymmdd(F.col(c)) for c in SALES_DATES}
    return raw.withColumns(
        {
            **dates,
            "sls_sales": F.when(amount_wrong, expected.try_cast("int")).otherwise(amount),
            "sls_price": F.when(price_wrong, int_div("sls_sales", "sls_quantity")).otherwise(price),
        }
    )


def expected_amount() -> Column:
    """Quantity times absolute price, as a BIGINT."""
    return F.col("sls_quantity").cast("bigint") * F.abs(F.col("sls_price").cast("bigint"))


def too_large() -> Column:
    """Whether no INT holds the amount that a wrong one is repaired to; it becomes NULL."""
    amount, expected = F.col("sls_sales"), expected_amount()
    wrong = amount.isNull() | (amount <= 0) | (amount != expected)
    return wrong & expected.isNotNull() & expected.try_cast("int").isNull()


def sales_faults() -> list[Column]:
    """Counts over the raw sales: `bad_dates` (eight digits that are no day) and `large_amounts`."""
    bad = [F.count_if(_no_day(c)) for c in SALES_DATES]
    return [reduce(lambda a, b: a + b, bad).alias("bad_dates"), F.count_if(too_large()).alias("large_amounts")]


def _no_day(column: str) -> Column:
    return eight_digits(F.col(column)) & yyyymmdd(F.col(column)).isNull()


def bad_sales_dates(raw: DataFrame) -> DataFrame:
    """Per date column, values with eight digits that are no day (they become NULL)."""
    counts = raw.agg(*[F.count_if(_no_day(c)).alias(c) for c in SALES_DATES])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("bad_rows")) for c in SALES_DATES
    ]
    return counts.select(F.inline(F.array(*pairs)))


def clean_erp_cust_az12(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Customer number without its prefix, no birth dates after `as_of`."""
    number = F.col("cid")
    born = F.col("bdate")
    return raw.select(
        F.when(number.startswith(CUSTOMER_PREFIX), F.expr(f"substring(cid, {len(CUSTOMER_PREFIX) + 1})"))
        .otherwise(number)
        .alias("cid"),
        F.when(born <= F.lit(as_of), born).alias("bdate"),
        map_codes(F.col("gen"), GENDER_WORDS).alias("gen"),
    )


def clean_erp_loc_a101(raw: DataFrame) -> DataFrame:
    """Customer number without dashes and a country name."""
    country = F.trim("cntry")
    named = F.create_map(*[F.lit(x) for kv in COUNTRY.items() for x in kv])[country]
    return raw.select(
        F.translate("cid", "-", "").alias("cid"),
        F.coalesce(named, F.nullif(country, F.lit("")), F.lit(UNKNOWN)).alias("cntry"),
    )


def clean_erp_px_cat_g1v2(raw: DataFrame) -> DataFrame:
    return raw.select("id", "cat", "subcat", "maintenance")
