"""Customer and product KPI reports.

Each works on keys until the measures are one row per key and adds the
descriptive columns last. `keys_resolved` skips the lookup that gathers orphans
under NULL, for a fact whose keys all exist.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_diff, year_diff
from ..functions.values import full_name, ratio
from ..operators.rollup import attach, measures_by_key
from .analytics import VIP_MONTHS, VIP_SALES, customer_segment

TOTALS = {
    "total_sales": ("sum", "sales_amount"),
    "total_quantity": ("sum", "quantity"),
    "first_order_date": ("min", "order_date"),
    "last_order_date": ("max", "order_date"),
}

# Default product tiers.
HIGH_SALES, MID_SALES = 50000, 10000


def _per(total: Column, parts: Column) -> Column:
    """Total per part; the total itself when there are no parts to divide by."""
    return F.when(parts == 0, total.cast("double")).otherwise(ratio(total, parts))


def age_group(age: Column) -> Column:
    """Ten-year groups; a missing age falls in the oldest."""
    groups = F.when(age < 20, "Under 20")
    for start in (20, 30, 40):
        groups = groups.when(age.between(start, start + 9), f"{start}-{start + 9}")
    return groups.otherwise("50 and above")


def report_customers(
    fact: DataFrame,
    customers: DataFrame,
    as_of: dt.date,
    vip_months: int = VIP_MONTHS,
    vip_sales: float = VIP_SALES,
    keys_resolved: bool = False,
) -> DataFrame:
    dated = fact.filter(F.col("order_date").isNotNull()).select(
        "customer_key", "order_number", "product_key", "order_date", "sales_amount", "quantity"
    )
    counted = {"total_orders": "order_number", "total_products": "product_key"}
    totals = measures_by_key(dated, customers, "customer_key", counted, TOTALS, keys_resolved)
    measures = totals.withColumn("lifespan", month_diff(F.col("first_order_date"), F.col("last_order_date")))
    people = customers.select(
        "customer_key",
        "customer_number",
        full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        year_diff(F.col("birthdate"), F.lit(as_of)).alias("age"),
    )
    rows = attach(measures, people, "customer_key", ["customer_number", "customer_name", "age"])
    sales, lifespan = F.col("total_sales"), F.col("lifespan")
    return rows.select(
        "customer_key",
        "customer_number",
        # an orphan group has no row to take names from: both count as empty
        F.coalesce("customer_name", F.lit(" ")).alias("customer_name"),
        "age",
        age_group(F.col("age")).alias("age_group"),
        customer_segment(lifespan, sales, vip_months, vip_sales).alias("customer_segment"),
        "last_order_date",
        month_diff(F.col("last_order_date"), F.lit(as_of)).alias("recency"),
        "total_orders",
        "total_sales",
        "total_quantity",
        "total_products",
        "lifespan",
        F.when(sales == 0, 0.0)
        .otherwise(ratio(sales, F.col("total_orders")))
        .alias("avg_order_value"),
        _per(sales, lifespan).alias("avg_monthly_spend"),
    )


def product_tier(sales: Column, high: float = HIGH_SALES, mid: float = MID_SALES) -> Column:
    return (
        F.when(sales > high, "High-Performer")
        .when(sales >= mid, "Mid-Range")
        .otherwise("Low-Performer")
    )


def report_products(
    fact: DataFrame,
    products: DataFrame,
    as_of: dt.date,
    high_sales: float = HIGH_SALES,
    mid_sales: float = MID_SALES,
    keys_resolved: bool = False,
) -> DataFrame:
    dated = fact.filter(F.col("order_date").isNotNull()).select(
        "product_key", "order_number", "customer_key", "order_date", "sales_amount", "quantity"
    )
    priced = dated.withColumn("unit_price", ratio(F.col("sales_amount"), F.col("quantity")))
    counted = {"total_orders": "order_number", "total_customers": "customer_key"}
    prices = {"price_sum": ("sum", "unit_price"), "price_count": ("count", "unit_price")}
    totals = measures_by_key(priced, products, "product_key", counted, TOTALS | prices, keys_resolved)
    measures = totals.withColumns(
        {
            "lifespan": month_diff(F.col("first_order_date"), F.col("last_order_date")),
            "last_sale_date": F.col("last_order_date"),
            "avg_selling_price": F.round(ratio(F.col("price_sum"), F.col("price_count")), 1),
        }
    )
    labels = ["product_name", "category", "subcategory", "cost"]
    rows = attach(measures, products, "product_key", labels)
    sales, lifespan = F.col("total_sales"), F.col("lifespan")
    return rows.select(
        "product_key",
        *labels,
        "last_sale_date",
        month_diff(F.col("last_sale_date"), F.lit(as_of)).alias("recency_in_months"),
        product_tier(sales, high_sales, mid_sales).alias("product_segment"),
        "lifespan",
        "total_orders",
        "total_sales",
        "total_quantity",
        "total_customers",
        "avg_selling_price",
        F.when(F.col("total_orders") == 0, 0.0)
        .otherwise(ratio(sales, F.col("total_orders")))
        .alias("avg_order_revenue"),
        _per(sales, lifespan).alias("avg_monthly_revenue"),
    )


def publish_view(report: DataFrame, name: str) -> DataFrame:
    """Make a report readable by name in SQL, replacing an older one."""
    report.createOrReplaceTempView(name)
    return report
