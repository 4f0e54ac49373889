"""Trends, running totals, year-over-year, segments, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_diff
from ..functions.values import mean, ratio
from ..operators.rollup import rollup_by, with_share

GRAINS = {"day": "DD", "month": "MM", "quarter": "QUARTER", "year": "YEAR"}

# Default thresholds.
VIP_MONTHS, VIP_SALES = 12, 5000
COST_BANDS = [100, 500, 1000]


def _period(day: Column, grain: str) -> Column:
    return day if grain == "day" else F.trunc(day, GRAINS[grain])


def _trend(fact: DataFrame, periods: dict[str, Column]) -> DataFrame:
    dated = fact.filter(F.col("order_date").isNotNull())
    totals = dated.groupBy(*[e.alias(n) for n, e in periods.items()]).agg(
        F.sum("sales_amount").alias("total_sales"),
        F.countDistinct("customer_key").alias("total_customers"),
        F.sum("quantity").alias("total_quantity"),
    )
    return totals.orderBy(*periods)


def trend_by_year_month(fact: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return _trend(fact, {"order_year": F.year(day), "order_month": F.month(day)})


def trend_by_period(fact: DataFrame, grain: str = "month") -> DataFrame:
    return _trend(fact, {"order_period": _period(F.col("order_date"), grain)})


def trend_by_label(fact: DataFrame, pattern: str = "yyyy-MMM") -> DataFrame:
    """By text label such as 2001-Apr; labels sort as text."""
    return _trend(fact, {"order_label": F.date_format("order_date", pattern)})


def cumulative_sales(fact: DataFrame, grain: str = "year") -> DataFrame:
    """Sales per period, their running total, and the running mean of period prices.

    The running window has no partition: it sees one row per calendar period.
    """
    periods = (
        fact.filter(F.col("order_date").isNotNull())
        .groupBy(_period(F.col("order_date"), grain).alias("order_period"))
        .agg(F.sum("sales_amount").alias("total_sales"), mean(F.col("price")).alias("_price"))
    )
    so_far = Window.orderBy("order_period").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return periods.select(
        "order_period",
        "total_sales",
        F.sum("total_sales").over(so_far).alias("running_total_sales"),
        (F.sum("_price").over(so_far) / F.count("_price").over(so_far)).alias(
            "moving_average_price"
        ),
    ).orderBy("order_period")


def _sign_label(value: Column, up: str, down: str, same: str) -> Column:
    return F.when(value > 0, up).when(value < 0, down).otherwise(same)


def performance_by_year(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Yearly sales of each product against its own mean and its previous year."""
    yearly = rollup_by(
        fact.filter(F.col("order_date").isNotNull()),
        products,
        "product_key",
        ["product_name"],
        {"current_sales": ("sum", "sales_amount")},
        {"order_year": F.year("order_date")},
    )
    product = Window.partitionBy("product_name")  # one row per year
    sales = F.col("current_sales")
    measured = yearly.withColumns(
        {
            "avg_sales": ratio(F.sum(sales).over(product), F.count(sales).over(product)),
            "py_sales": F.lag(sales).over(product.orderBy("order_year")),
        }
    ).withColumns(
        {
            "diff_avg": sales.cast("double") - F.col("avg_sales"),
            "diff_py": sales - F.col("py_sales"),
        }
    )
    return measured.select(
        "order_year",
        "product_name",
        "current_sales",
        "avg_sales",
        "diff_avg",
        _sign_label(F.col("diff_avg"), "Above Avg", "Below Avg", "Avg").alias("avg_change"),
        "py_sales",
        "diff_py",
        _sign_label(F.col("diff_py"), "Increase", "Decrease", "No Change").alias("py_change"),
    ).orderBy("product_name", "order_year")


def cost_band(cost: Column, edges: list[int] = COST_BANDS) -> Column:
    """Band label; an edge belongs to the band below it, except the first.

    A missing cost falls in the top band.
    """
    low, *_, high = edges
    band = F.when(cost < low, f"Below {low}")
    for a, b in zip(edges, edges[1:]):
        band = band.when(cost.between(a, b), f"{a}-{b}")
    return band.otherwise(f"Above {high}")


def products_by_cost(products: DataFrame, edges: list[int] = COST_BANDS) -> DataFrame:
    banded = products.groupBy(cost_band(F.col("cost"), edges).alias("cost_range"))
    counted = banded.agg(F.count("product_key").alias("total_products"))
    return counted.orderBy(F.col("total_products").desc(), "cost_range")


def customer_segment(
    lifespan: Column, sales: Column, months: int = VIP_MONTHS, amount: float = VIP_SALES
) -> Column:
    """VIP and Regular for long histories, New for the rest and for missing values."""
    settled = lifespan >= months
    return (
        F.when(settled & (sales > amount), "VIP")
        .when(settled & (sales <= amount), "Regular")
        .otherwise("New")
    )


def customers_by_segment(
    fact: DataFrame,
    customers: DataFrame,
    vip_months: int = VIP_MONTHS,
    vip_sales: float = VIP_SALES,
) -> DataFrame:
    spending = rollup_by(
        fact,
        customers,
        "customer_key",
        ["customer_key"],
        {
            "spent": ("sum", "sales_amount"),
            "first": ("min", "order_date"),
            "last": ("max", "order_date"),
        },
    )
    lifespan = month_diff(F.col("first"), F.col("last"))
    segment = customer_segment(lifespan, F.col("spent"), vip_months, vip_sales)
    counted = spending.groupBy(segment.alias("customer_segment")).agg(
        F.count("customer_key").alias("total_customers")
    )
    return counted.orderBy(F.col("total_customers").desc(), "customer_segment")


def category_share(fact: DataFrame, products: DataFrame) -> DataFrame:
    totals = rollup_by(
        fact, products, "product_key", ["category"], {"total_sales": ("sum", "sales_amount")}
    )
    shared = with_share(totals, "total_sales", "overall_sales", "percentage_of_total")
    return shared.orderBy(F.col("total_sales").desc(), "category")
