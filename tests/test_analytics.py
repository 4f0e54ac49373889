import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.rollup import measures_by_key, rollup_by
from tallyhouse.operators.topk import top_k_with_ties
from tallyhouse.plans import analytics, explore, reports

D = dt.date
FACT = (
    "order_number string, product_key int, customer_key int, order_date date, "
    "sales_amount decimal(18,2), quantity int, price decimal(18,2)"
)
CUSTOMERS = (
    "customer_key int, customer_number string, first_name string, last_name string, "
    "country string, birthdate date"
)
PRODUCTS = (
    "product_key int, product_name string, category string, subcategory string, cost decimal(18,2)"
)


@pytest.fixture(scope="module")
def star(spark):
    """Customer 1 holds most rows; keys 90 and 91 have no dimension row."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        who = 1 if rng.random() < 0.5 else rng.choice([2, 3, 4, 90, 91, None])
        what = 10 if rng.random() < 0.4 else rng.choice([11, 12, 90, 91, None])
        day = rng.choice([None, D(2019, 1, 1) + dt.timedelta(days=rng.randrange(700))])
        amount = Decimal(rng.randrange(1, 9000)) / 100
        rows.append((f"SO{rng.randrange(300)}", what, who, day, amount, rng.randrange(4), amount))
    fact = spark.createDataFrame(rows, FACT).repartition(5)
    customers = spark.createDataFrame(
        [
            (1, "A1", "Ann", None, "DE", D(1990, 5, 1)),
            (2, "A2", None, None, None, None),
            (3, "A3", "Cy", "Ko", "DE", D(2002, 12, 31)),
            (4, "A4", "Di", "Lu", "FR", D(1950, 1, 1)),
        ],
        CUSTOMERS,
    )
    products = spark.createDataFrame(
        [
            (10, "bike", "Bikes", "Road", Decimal(100)),
            (11, "bike", "Bikes", "City", Decimal(500)),
            (12, "bell", None, None, None),
        ],
        PRODUCTS,
    )
    return fact, customers, products


def joined(fact, dim, key):
    keyed = dim.withColumnRenamed(key, "_k")
    out = fact.join(keyed, F.col(key) == F.col("_k"), "left")
    return out.drop(key).withColumnRenamed("_k", key)


@pytest.mark.parametrize("by", [["country"], ["customer_key", "first_name"]])
def test_rollup_equals_join_then_group(star, tuples, by):
    fact, customers, _ = star
    measures = {
        "total": ("sum", "sales_amount"),
        "first": ("min", "order_date"),
        "last": ("max", "order_date"),
        "n": ("count", "order_number"),
    }
    reduced = rollup_by(
        fact, customers, "customer_key", by, measures, {"y": F.year("order_date")}
    )
    plain = (
        joined(fact, customers, "customer_key")
        .groupBy(F.year("order_date").alias("y"), *by)
        .agg(
            F.sum("sales_amount").alias("total"),
            F.min("order_date").alias("first"),
            F.max("order_date").alias("last"),
            F.count("order_number").alias("n"),
        )
    )
    assert tuples(reduced.select(plain.columns)) == tuples(plain)


def test_distinct_counts_put_orphans_together(star):
    fact, customers, products = star
    report = {r.customer_key: r for r in reports.report_customers(fact, customers, D(2021, 1, 1)).collect()}
    assert set(report) == {1, 2, 3, 4, None}
    for key, row in report.items():
        mine = [
            r
            for r in fact.filter("order_date IS NOT NULL").collect()
            if (r.customer_key if r.customer_key in (1, 2, 3, 4) else None) == key
        ]
        assert row.total_orders == len({r.order_number for r in mine})
        assert row.total_products == len({r.product_key for r in mine} - {None})
        assert row.total_sales == sum(r.sales_amount for r in mine)
    assert report[1].customer_name == "Ann "
    assert report[None].customer_name == " " and report[None].age_group == "50 and above"
    assert (report[3].age, report[1].age_group) == (19, "30-39")

    goods = {r.product_key: r for r in reports.report_products(fact, products, D(2021, 1, 1)).collect()}
    assert set(goods) == {10, 11, 12, None}
    lost = fact.filter("order_date IS NOT NULL AND (product_key > 12 OR product_key IS NULL)")
    assert goods[None].total_orders == lost.select("order_number").distinct().count()


@pytest.mark.parametrize("orphans", [True, False])
def test_measures_by_key_match_plain_counting(spark, orphans):
    rng = random.Random(3)
    rows = []
    for _ in range(500):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", *(["lost", "gone", None] if orphans else [])])
        rows.append((key, rng.choice([None, *range(40)]), rng.randrange(15), rng.choice([None, 1, 2, 3])))
    fact = spark.createDataFrame(rows, "k string, o int, p int, v int").repartition(5)
    dim = spark.createDataFrame([("hot",), ("a",), ("b",), ("idle",)], "k string")
    distinct, measures = {"orders": "o", "goods": "p"}, {"total": ("sum", "v"), "least": ("min", "v"), "values": ("count", "v")}
    got = measures_by_key(fact, dim, "k", distinct, measures)
    groups = defaultdict(list)
    for k, o, p, v in rows:
        groups[k if k in ("hot", "a", "b") else None].append((o, p, v))
    want = set()
    for k, group in groups.items():
        o, p, v = ({x for x in column if x is not None} for column in zip(*group))
        vs = [x[2] for x in group if x[2] is not None]
        want.add((k, len(o), len(p), sum(vs), min(v), len(vs)))
    assert set(map(tuple, got.collect())) == want and got.count() == len(want)
    if not orphans:
        known = measures_by_key(fact, dim, "k", distinct, measures, keys_resolved=True)
        assert set(map(tuple, known.collect())) == want
    empty = measures_by_key(fact.limit(0), dim, "k", distinct, measures)
    assert empty.columns == ["k", "orders", "goods", "total", "least", "values"] and empty.isEmpty()


def test_single_order_customer(spark):
    fact = spark.createDataFrame(
        [("SO1", 10, 1, D(2020, 1, 1), Decimal("30"), 0, None)], FACT
    )
    people = spark.createDataFrame([(1, "A1", "Ann", None, "DE", None)], CUSTOMERS)
    row = reports.report_customers(fact, people, D(2020, 3, 1)).first()
    assert (row.customer_segment, row.lifespan, row.recency) == ("New", 0, 2)
    assert (row.avg_monthly_spend, row.avg_order_value) == (30.0, 30.0)
    goods = spark.createDataFrame([(10, "bike", "Bikes", "Road", Decimal(1))], PRODUCTS)
    assert reports.report_products(fact, goods, D(2020, 3, 1)).first().avg_selling_price is None


@pytest.mark.parametrize("k", [1, 3, 5, 50])
def test_top_k_with_ties(spark, k):
    rng = random.Random(k)
    values = [rng.choice([None, 1, 2, 2, 3, 7, 7, 9]) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(4)
    got = {(r.id, r.v, r.r) for r in top_k_with_ties(df, k, "v", "r").collect()}
    above = lambda v: sum(1 for w in values if w is not None and (v is None or w > v))
    want = {(i, v, above(v) + 1) for i, v in enumerate(values) if above(v) + 1 <= k}
    assert got == want


def test_grains_and_options(star):
    fact, customers, products = star
    years = analytics.cumulative_sales(fact).collect()
    months = analytics.cumulative_sales(fact, "month").collect()
    assert years[-1].running_total_sales == months[-1].running_total_sales
    assert [r.order_period for r in months] == sorted(r.order_period for r in months)
    days = analytics.trend_by_period(fact, "day")
    assert days.count() == fact.filter("order_date IS NOT NULL").select("order_date").distinct().count()
    both = customers.withColumn("scd_is_current", F.col("customer_key") > 1)
    assert explore.customer_count(both).first()[0] == 4
    assert explore.customer_count(both, current_only=True).first()[0] == 3


def test_year_over_year_labels(spark):
    rows = [("A", 10, 1, D(y, 1, 1), Decimal(a), 1, None) for y, a in ((2019, 10), (2020, 30), (2021, 20))]
    fact = spark.createDataFrame(rows, FACT)
    goods = spark.createDataFrame([(10, "bike", "Bikes", "Road", Decimal(1))], PRODUCTS)
    got = analytics.performance_by_year(fact, goods).collect()
    assert [(r.order_year, r.avg_change, r.py_change) for r in got] == [
        (2019, "Below Avg", "No Change"),
        (2020, "Above Avg", "Increase"),
        (2021, "Avg", "Decrease"),
    ]


def test_report_view(star, spark):
    fact, customers, _ = star
    reports.publish_view(reports.report_customers(fact, customers, D(2021, 1, 1)), "report_customers")
    assert spark.sql("SELECT count(*) FROM report_customers").first()[0] == 5


def test_the_fact_is_read_once_a_count_to_find_orphans(spark):
    fact = spark.range(900).selectExpr("id % 7 AS k", "id % 11 AS a", "id % 5 AS b", "id AS v")
    dim = spark.createDataFrame([(k,) for k in range(5)], "k long")
    got = measures_by_key(fact, dim, "k", {"as": "a", "bs": "b"}, {"total": ("sum", "v")})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 900") == 2
    lost = {r for r in range(900) if r % 7 > 4}
    row = got.where("k IS NULL").first()
    assert (row["as"], row.bs, row.total) == (len({r % 11 for r in lost}), len({r % 5 for r in lost}), sum(lost))
