import datetime as dt

from tallyhouse.plans import quality

D = dt.date


def test_seeded_faults_are_found(spark, tuples):
    customers = spark.createDataFrame(
        [
            (1, 7, D(2020, 1, 1), None, True),
            (2, 7, D(2020, 2, 1), None, True),  # second open version
            (2, 8, D(2020, 1, 1), D(2019, 12, 31), False),  # key used twice, ends too early
            (4, None, D(2020, 1, 1), D(2021, 1, 1), True),  # no id, open yet ended
        ],
        "customer_key int, customer_id int, scd_start_date date, scd_end_date date, scd_is_current boolean",
    )
    fact = spark.createDataFrame(
        [("A", "P", 1), ("A", "P", 1), ("B", "P", 5), ("C", "P", None), ("D", "P", 5)],
        "order_number string, product_number string, customer_key int",
    )
    tables = {"dim_customers": customers, "fact_sales": fact}
    assert tuples(quality.primary_key_faults(tables)) == [
        ("dim_customers", "2", 2),
        ("fact_sales", "A|P", 2),
    ]
    goods = fact.selectExpr("1 AS product_key").limit(1)
    days = fact.selectExpr("DATE '2020-01-01' AS date_key").limit(1)
    wide = fact.selectExpr("*", "1 AS product_key", "DATE '2020-01-01' AS date_key")
    star = {"fact_sales": wide, "dim_customers": customers, "dim_products": goods, "dim_date": days}
    assert tuples(quality.foreign_key_faults(star)) == [("fact_sales", "customer_key", "5", 2)]
    found = tuples(quality.not_null_faults(tables))
    assert [f for f in found if f[2] is not None] == [
        ("dim_customers", "customer_id", 1),
        ("fact_sales", "customer_key", 1),
    ]
    assert ("fact_sales", "date_key", None) in found and ("dim_customers", "customer_number", None) in found
    unchecked = tuples(quality.foreign_key_faults({"fact_sales": wide, "dim_customers": customers, "dim_date": days}))
    assert ("fact_sales", "product_key", None, None) in unchecked and ("fact_sales", "customer_key", "5", 2) in unchecked
    assert quality.unresolved_customers(fact, customers).first()[0] == 3
    assert tuples(quality.current_not_unique(customers, "customer_id")) == [(7, 2)]
    assert tuples(quality.period_faults({"dim_customers": (customers, "customer_key")})) == [
        ("dim_customers", 2, D(2020, 1, 1), D(2019, 12, 31), False),
        ("dim_customers", 4, D(2020, 1, 1), D(2021, 1, 1), True),
    ]
    assert {r.tbl: r.n for r in quality.row_counts(tables).collect()} == {
        "dim_customers": 4,
        "fact_sales": 5,
    }


def test_clean_tables_pass(spark):
    customers = spark.createDataFrame([(1, 7, True)], "customer_key int, customer_id int, scd_is_current boolean")
    assert quality.current_not_unique(customers, "customer_id").count() == 0
    fact = spark.createDataFrame([("A", 1)], "order_number string, customer_key int")
    assert quality.unresolved_customers(fact, customers).first()[0] == 0
