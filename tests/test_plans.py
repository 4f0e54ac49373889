"""Shape of the physical plans: what would hurt at scale must not be in them."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyhouse import schemas
from tallyhouse.operators import history, merge
from tallyhouse.plans import gold

# queries that load tables while they are built, so their last plan is a mere scan
LOADS = {"bronze_load", "gold_load_all", "dq_load_log_tail", "dq_scd_ranges"}
LOADS |= {"gold_scd_customers", "gold_scd_products", "gold_second_load", "dq_load_log_changes"}
LOADS |= {"gold_second_dim_customers", "gold_second_dim_products"}
LAZY = [k for k in entry.PLANS if k not in LOADS]

# broadcasts of at most k rows, or of one row per key bucket
BOUNDED_BROADCAST = {"rank_top5_products_window", "gold_surrogate_keys"}
# windows without a partition: one row per year, per bucket or per top-k place
BOUNDED_WINDOW = {"cumulative_sales", *BOUNDED_BROADCAST}


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Initial plans as for tables far above the broadcast limit."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = {
        key: entry.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for key in LAZY
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return found


@pytest.mark.parametrize("key", LAZY)
def test_no_operator_that_cannot_scale(plans, key):
    plan = plans[key]
    for name in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "LocalTableScan"):
        assert name not in plan, name
    if key not in BOUNDED_BROADCAST:
        assert "BroadcastExchange" not in plan
    if key not in BOUNDED_WINDOW:
        assert not re.search(r"Window .*\n.*Sort.*\n.*Exchange SinglePartition", plan)


def test_scans_read_only_what_is_used(plans):
    plan = plans["mag_revenue_by_category"]
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    read = {s for s in schemas if "l_orderkey" in s}
    assert read == {"l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double"}
    assert "IsNotNull(l_orderkey)" in plan


@pytest.mark.parametrize(
    "key", ["mag_revenue_by_category", "mag_revenue_by_customer", "segment_customers", "performance_yoy"]
)
def test_fact_is_reduced_before_it_meets_the_dimension(plans, key):
    """From the fact upwards: partial sums, shuffle by key, join, sums again."""
    plan = plans[key]
    join = plan.index("[_fact_key")
    assert plan.index("HashAggregate", join) < plan.index("FileScan", join)
    assert "partial_sum(sales_amount" in plan[join:]


def test_distinct_counts_spread_a_hot_key(plans):
    """Rows are not copied; the wide shuffles are by key and counted value, and no fact row meets a dimension."""
    for key, by, others in (
        ("report_customers", "customer_key", ["order_number", "product_key"]),
        ("report_products", "product_key", ["order_number", "customer_key"]),
        ("rank_bottom3_customers", "customer_key", ["order_number"]),
    ):
        plan = plans[key]
        assert "Expand" not in plan
        for other in others:
            assert re.search(rf"hashpartitioning\({by}#\d+L?, {other}#\d+L?", plan)


@pytest.fixture
def large(spark):
    """Settings under which small tables are planned like large ones."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def sample(spark, layout):
    """Rows of any layout; numbers and texts differ per row."""
    n = F.col("id")
    plain = ("int", "bigint", "string")
    return spark.range(0, 100, 1, 4).select(
        *[
            (n if f.dataType.simpleString() in plain else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in layout.fields
        ]
    )


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_history_and_merge_shuffle_each_side_once(spark, large):
    """The uniqueness check rides on the shuffle and sort of the join."""
    dim = sample(spark, schemas.GOLD["dim_customers"])
    changes = history.scd2_changes(
        dim, dim, "customer_id", gold.CUSTOMER_TRACKED, "customer_key",
        dt.date(2020, 1, 1), dt.datetime(2020, 1, 1),
    )
    assert shuffles(changes) == 2
    fact = sample(spark, schemas.GOLD["fact_sales"])
    args = (gold.FACT_KEYS, gold.FACT_COMPARE, gold.FACT_SET)
    assert shuffles(merge.merge_delta(fact, fact, *args, {})) == 2
    assert shuffles(merge.upsert(fact, fact, *args)) == 2


def test_hot_product_is_split_when_sales_are_staged(spark, large):
    """Half of the sales are of one product; its join partition is read in slices."""
    n = F.col("id")
    sales = spark.range(0, 200_000, 1, 16).select(
        F.concat(F.lit("SO"), n).alias("sls_ord_num"),
        F.when(n % 2 == 0, "P0").otherwise(F.concat(F.lit("P"), n % 500)).alias("sls_prd_key"),
        (n % 50).cast("int").alias("sls_cust_id"),
        *[F.lit(dt.date(2020, 1, 1)).alias(c) for c in gold.SALES_DATE_ORDER],
        *[n.cast("int").alias(c) for c in ("sls_sales", "sls_quantity", "sls_price")],
    )
    products = spark.range(500).select(
        F.concat(F.lit("P"), n).alias("product_number"),
        n.alias("product_key"),
        F.lit(True).alias("scd_is_current"),
    )
    customers = spark.range(50).select(
        n.cast("int").alias("customer_id"),
        n.alias("customer_key"),
        F.lit(True).alias("scd_is_current"),
    )
    staged = gold.stage_sales(sales, products, customers)
    staged.collect()
    plan = staged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "skew=true" in plan
    assert staged.filter("product_key IS NULL").count() == 0
