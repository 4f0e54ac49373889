import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import history
from tallyhouse.plans import gold
from tallyhouse.sources.scratch import materialize
from tallyhouse.sources.snapshots import empty_table

D = dt.date
STAGE = (
    "customer_id int, customer_number string, first_name string, last_name string, "
    "country string, marital_status string, gender string, birthdate date, create_date date"
)
PRODUCT_STAGE = (
    "product_id int, product_number string, product_name string, category_id string, "
    "category string, subcategory string, maintenance string, cost decimal(18,2), "
    "product_line string"
)


def customer(i, country="DE", name="Ann"):
    return (i, f"C{i}", name, "Lee", country, "Single", "Female", None, None)


def product(i, cost="12", category="Bikes"):
    return (i, f"P{i}", "Bike", "BI_RB", category, None, "Yes", Decimal(cost), "Road")


def load(dim, stage, as_of, table="dim_customers", **options):
    now = dt.datetime.combine(as_of, dt.time(8), dt.timezone.utc)
    kind = {
        "dim_customers": ("customer_id", gold.CUSTOMER_TRACKED, "customer_key"),
        "dim_products": ("product_id", gold.PRODUCT_TRACKED, "product_key"),
    }[table]
    return history.scd2_apply(dim, stage, *kind, as_of, now, **options)


def versions(dim, key="customer_id", attribute="country"):
    out = defaultdict(list)
    for r in dim.orderBy(key, "scd_start_date").collect():
        out[r[key]].append((r[attribute], r.scd_start_date, r.scd_end_date, r.scd_is_current))
    return dict(out)


def test_customers_keep_change_and_add(spark):
    empty = empty_table(spark, schemas.GOLD["dim_customers"])
    day1 = spark.createDataFrame([customer(1), customer(2), customer(3), customer(4, None)], STAGE)
    day2 = spark.createDataFrame(
        [customer(1), customer(2, "FR"), customer(3, name="Eve"), customer(5)], STAGE
    )
    first = load(empty, day1, D(2020, 1, 1))
    second = load(first.drop(history.ACTION), day2, D(2020, 2, 1))
    open_jan = (D(2020, 1, 1), None, True)
    assert versions(second) == {
        1: [("DE", *open_jan)],
        2: [("DE", D(2020, 1, 1), D(2020, 1, 31), False), ("FR", D(2020, 2, 1), None, True)],
        3: [("DE", *open_jan)],  # the name is not tracked
        4: [(None, *open_jan)],  # missing customers stay open
        5: [("DE", D(2020, 2, 1), None, True)],
    }
    assert {r.customer_id: r.first_name for r in second.filter("customer_id = 3").collect()} == {
        3: "Ann"
    }
    keys = [r.customer_key for r in second.collect()]
    assert sorted(keys) == [1, 2, 3, 4, 5, 6]
    assert history.action_counts(second) == {"keep": 3, "expire": 1, "insert": 2}
    old_keys = {r.customer_id: r.customer_key for r in first.collect()}
    kept = second.filter(F.col(history.ACTION) != "insert").collect()
    assert {r.customer_id: r.customer_key for r in kept} == old_keys


def test_products_expire_return_and_compare_cost_as_number(spark):
    table = "dim_products"
    dim = empty_table(spark, schemas.GOLD[table])
    days = [
        (D(2020, 1, 1), [product(1), product(2)]),
        (D(2020, 2, 1), [product(1, "12.00")]),  # 2 is gone, 12 equals 12.00
        (D(2020, 3, 1), [product(1, "13"), product(2)]),  # 2 is back
    ]
    for as_of, rows in days:
        stage = spark.createDataFrame(rows, PRODUCT_STAGE)
        dim = load(dim, stage, as_of, table, expire_missing=True).drop(history.ACTION)
    assert versions(dim, "product_id", "cost") == {
        1: [
            (Decimal("12.00"), D(2020, 1, 1), D(2020, 2, 29), False),
            (Decimal("13.00"), D(2020, 3, 1), None, True),
        ],
        2: [
            (Decimal("12.00"), D(2020, 1, 1), D(2020, 1, 31), False),
            (Decimal("12.00"), D(2020, 3, 1), None, True),
        ],
    }


def test_null_changes_count(spark):
    empty = empty_table(spark, schemas.GOLD["dim_customers"])
    stage = spark.createDataFrame([customer(1, None), customer(2, "DE")], STAGE)
    first = load(empty, stage, D(2020, 1, 1)).drop(history.ACTION)
    swapped = spark.createDataFrame([customer(1, "DE"), customer(2, None)], STAGE)
    assert history.action_counts(load(first, swapped, D(2020, 2, 1))) == {
        "expire": 2,
        "insert": 2,
    }
    assert history.action_counts(load(first, stage, D(2020, 2, 1))) == {"keep": 2}


def test_repeated_stage_key_fails(spark):
    empty = empty_table(spark, schemas.GOLD["dim_customers"])
    stage = spark.createDataFrame([customer(1), customer(1, "FR")], STAGE)
    with pytest.raises(Exception, match="stage: repeated or missing key"):
        load(empty, stage, D(2020, 1, 1)).collect()


def test_random_days_match_a_plain_replay(spark):
    rng = random.Random(5)
    dim = empty_table(spark, schemas.GOLD["dim_products"])
    replay: dict[int, list] = {}
    for month in (1, 2, 3, 4):
        as_of = D(2020, month, 1)
        day = {i: rng.choice(["A", "B", None]) for i in range(30) if rng.random() < 0.7}
        stage = spark.createDataFrame([product(i, category=c) for i, c in day.items()], PRODUCT_STAGE)
        loaded = load(dim, stage, as_of, "dim_products", expire_missing=True)
        dim = materialize(loaded.drop(history.ACTION))
        for i in range(30):
            rows = replay.setdefault(i, [])
            is_open = bool(rows) and rows[-1][3]
            if is_open and (i not in day or rows[-1][0] != day[i]):
                rows[-1] = (*rows[-1][:2], as_of - dt.timedelta(days=1), False)
                is_open = False
            if i in day and not is_open:
                rows.append((day[i], as_of, None, True))
    assert versions(dim, "product_id", "category") == {i: r for i, r in replay.items() if r}
    keys = [r.product_key for r in dim.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
