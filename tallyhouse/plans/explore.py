"""Exploration: distinct values, ranges, key metrics, magnitudes, rankings.

Dimension counts cover every version of a member unless `current_only` is set.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_diff, year_diff
from ..functions.values import mean
from ..operators.rollup import attach, measures_by_key, rollup_by
from ..operators.topk import top_k, top_k_with_ties

CUSTOMER_NAME = ["customer_key", "first_name", "last_name"]
REVENUE = {"total_revenue": ("sum", "sales_amount")}


def versions(dim: DataFrame, current_only: bool) -> DataFrame:
    return dim.filter("scd_is_current") if current_only else dim


def countries(customers: DataFrame) -> DataFrame:
    return customers.select("country").distinct().orderBy("country")


def product_tree(products: DataFrame) -> DataFrame:
    levels = ["category", "subcategory", "product_name"]
    return products.select(*levels).distinct().orderBy(*levels)


def order_range(fact: DataFrame) -> DataFrame:
    ends = fact.agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")
    )
    months = month_diff(F.col("first_order_date"), F.col("last_order_date"))
    return ends.withColumn("order_range_months", months)


def age_range(customers: DataFrame, as_of: dt.date) -> DataFrame:
    today = F.lit(as_of)
    ends = customers.agg(F.min("birthdate").alias("lo"), F.max("birthdate").alias("hi"))
    return ends.select(
        F.col("lo").alias("oldest_birthdate"),
        year_diff(F.col("lo"), today).alias("oldest_age"),
        F.col("hi").alias("youngest_birthdate"),
        year_diff(F.col("hi"), today).alias("youngest_age"),
    )


def total_sales(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("sales_amount").alias("total_sales"))


def total_quantity(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("quantity").alias("total_quantity"))


def average_price(fact: DataFrame) -> DataFrame:
    return fact.agg(mean(F.col("price")).alias("avg_price"))


def order_rows(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("order_number").alias("total_orders"))


def orders(fact: DataFrame) -> DataFrame:
    return fact.agg(F.countDistinct("order_number").alias("total_orders"))


def product_count(products: DataFrame, current_only: bool = False) -> DataFrame:
    return versions(products, current_only).agg(F.count("product_name").alias("total_products"))


def customer_count(customers: DataFrame, current_only: bool = False) -> DataFrame:
    return versions(customers, current_only).agg(F.count("customer_key").alias("total_customers"))


def buying_customers(fact: DataFrame) -> DataFrame:
    return fact.agg(F.countDistinct("customer_key").alias("total_customers"))


def key_metrics(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Six labelled measures; those of the fact come from one pass over it."""

    def labelled(totals: DataFrame, labels: dict[str, str]) -> DataFrame:
        rows = [
            F.struct(
                F.lit(label).alias("measure_name"),
                F.col(c).cast("double").alias("measure_value"),
            )
            for c, label in labels.items()
        ]
        return totals.select(F.inline(F.array(*rows)))

    sales = fact.agg(
        F.sum("sales_amount").alias("sales"),
        F.sum("quantity").alias("quantity"),
        mean(F.col("price")).alias("price"),
        F.countDistinct("order_number").alias("orders"),
    )
    parts = [
        labelled(
            sales,
            {
                "sales": "Total Sales",
                "quantity": "Total Quantity",
                "price": "Average Price",
                "orders": "Total Orders",
            },
        ),
        labelled(
            products.agg(F.countDistinct("product_name").alias("n")), {"n": "Total Products"}
        ),
        labelled(customers.agg(F.count("customer_key").alias("n")), {"n": "Total Customers"}),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def members_by(dim: DataFrame, column: str, key: str, name: str, current_only: bool = False):
    """Members per value of a dimension column, largest group first."""
    counted = versions(dim, current_only).groupBy(column).agg(F.count(key).alias(name))
    return counted.orderBy(F.col(name).desc(), column)


def average_cost_by_category(products: DataFrame) -> DataFrame:
    costs = products.groupBy("category").agg(mean(F.col("cost")).alias("avg_cost"))
    return costs.orderBy(F.col("avg_cost").desc(), "category")


def revenue_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    totals = rollup_by(fact, products, "product_key", ["category"], REVENUE)
    return totals.orderBy(F.col("total_revenue").desc(), "category")


def revenue_by_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    totals = rollup_by(fact, customers, "customer_key", CUSTOMER_NAME, REVENUE)
    return totals.orderBy(F.col("total_revenue").desc(), "customer_key")


def items_by_country(fact: DataFrame, customers: DataFrame) -> DataFrame:
    items = {"total_sold_items": ("sum", "quantity")}
    totals = rollup_by(fact, customers, "customer_key", ["country"], items)
    return totals.orderBy(F.col("total_sold_items").desc(), "country")


def product_revenue(fact: DataFrame, products: DataFrame) -> DataFrame:
    return rollup_by(fact, products, "product_key", ["product_name"], REVENUE)


def _largest() -> Column:
    return F.col("total_revenue").desc()


def top_products(fact: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    return top_k(product_revenue(fact, products), k, _largest(), F.col("product_name"))


def bottom_products(fact: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    totals = product_revenue(fact, products)
    return top_k(totals, k, F.col("total_revenue"), F.col("product_name"))


def top_products_ranked(fact: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    totals = product_revenue(fact, products)
    return top_k_with_ties(totals, k, "total_revenue", "rank_products")


def top_customers(fact: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    totals = rollup_by(fact, customers, "customer_key", CUSTOMER_NAME, REVENUE)
    return top_k(totals, k, _largest(), F.col("customer_key"))


def least_active_customers(
    fact: DataFrame, customers: DataFrame, k: int = 3, keys_resolved: bool = False
) -> DataFrame:
    """Customers with the fewest orders. Orders are counted by key, names come last.

    `keys_resolved` skips the orphan lookup for a fact whose keys all exist, as
    the fact load guarantees.
    """
    narrow = fact.select("customer_key", "order_number")
    counted = measures_by_key(
        narrow, customers, "customer_key", {"total_orders": "order_number"}, keys_resolved=keys_resolved
    )
    order = [F.col("total_orders"), F.col("customer_key")]
    named = attach(
        top_k(counted, k, *order), customers, "customer_key", ["first_name", "last_name"]
    )
    return named.select(*CUSTOMER_NAME, "total_orders").orderBy(*order)
