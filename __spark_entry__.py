"""

Every query reads the driver tables in full, through the star views and raw
feeds of `tallyhouse.testviews`; `oracle_sql` holds the DuckDB counterpart.
"""

from __future__ import annotations

import datetime as dt
import importlib
import itertools
import sys
import warnings
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import oracle  # noqa: E402
from tallyhouse import schemas, testviews  # noqa: E402
from tallyhouse.operators import merge  # noqa: E402
from tallyhouse.operators.history import scd2_apply  # noqa: E402
from tallyhouse.operators.keys import assign_keys  # noqa: E402
from tallyhouse.operators.rows import join_side  # noqa: E402
from tallyhouse.plans import analytics, explore, gold, quality, reports, runlog, silver  # noqa: E402
from tallyhouse.plans.warehouse import Warehouse  # noqa: E402
from tallyhouse.sources.catalog import list_columns, list_tables  # noqa: E402
from tallyhouse.sources.feeds import REJECT  # noqa: E402
from tallyhouse.sources.scratch import materialize, scratch_dir  # noqa: E402
from tallyhouse.sources.snapshots import empty_table  # noqa: E402

AS_OF = dt.date(2001, 12, 31)
NOW = dt.datetime(2001, 12, 31, 12, tzinfo=dt.timezone.utc)
VIP_MONTHS, VIP_SALES = 36, 2_000_000
HIGH_SALES, MID_SALES = 1_700_000, 1_400_000

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Money as DOUBLE and whole numbers as BIGINT, as in the oracle."""
    wider = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            wider[field.name] = "double"
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            wider[field.name] = "bigint"
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in wider.items()})


class Tables:
    """The driver tables of one folder with everything derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return testviews.frame(self.spark, self.sf_dir, name)

    # cleaned and staged tables

    def silver_customers(self) -> DataFrame:
        return silver.clean_crm_cust_info(self.bronze_cust_info)

    def silver_products(self) -> DataFrame:
        return silver.clean_crm_prd_info(self.bronze_prd_info)

    def stage_customers(self) -> DataFrame:
        return gold.stage_customers(
            self.silver_customers(),
            silver.clean_erp_cust_az12(self.bronze_erp_cust, AS_OF),
            silver.clean_erp_loc_a101(self.bronze_erp_loc),
        )

    def stage_products(self) -> DataFrame:
        return gold.stage_products(self.silver_products(), self.bronze_erp_cat)

    def stage_sales(self, sales: str = "bronze_sales_details") -> DataFrame:
        """Staged sales against dimensions keyed by their business keys."""
        products = self.silver_products().select(
            F.col("prd_key").alias("product_number"),
            F.col("prd_id").alias("product_key"),
            F.col("prd_end_dt").isNull().alias("scd_is_current"),
        )
        customers = self.stage_customers().select(
            "customer_id",
            F.col("customer_id").alias("customer_key"),
            F.lit(True).alias("scd_is_current"),
        )
        clean = silver.clean_crm_sales_details(getattr(self, sales))
        return gold.stage_sales(clean, products, customers)

    def feeds(self) -> dict[str, str]:
        """The raw tables written out as delimited feeds; table name to path."""
        sources = {
            "crm_cust_info": self.bronze_cust_info,
            "crm_prd_info": self.bronze_prd_info,
            "crm_sales_details": self.bronze_sales_details,
            "erp_cust_az12": self.bronze_erp_cust,
            "erp_loc_a101": self.bronze_erp_loc,
            "erp_px_cat_g1v2": self.bronze_erp_cat,
        }
        return {name: write_feed(df) for name, df in sources.items()}

    def loaded(self) -> Warehouse:
        warehouse = Warehouse(self.spark, scratch_dir(self.spark), lambda: NOW)
        warehouse.load_all(self.feeds())
        return warehouse

    # dimensions after several loads

    def _history(self, layout, days, business_key, tracked, key, expire_missing) -> DataFrame:
        dim = empty_table(self.spark, schemas.GOLD[layout])
        for as_of, stage in days:
            now = dt.datetime.combine(as_of, dt.time(12), dt.timezone.utc)
            loaded = scd2_apply(
                dim, stage, business_key, tracked, key, as_of, now, expire_missing
            )
            dim = materialize(loaded.select(*schemas.GOLD[layout].names))
        return dim

    def customer_days(self) -> tuple[DataFrame, DataFrame]:
        """Two deliveries of all customers: some are new, moved or renamed on the second."""
        first = self.dim_customers.withColumn("create_date", F.lit(None).cast("date"))
        k = F.col("customer_key")
        second = first.withColumns(
            {
                "country": F.when(k % 10 == 0, "MOVED").otherwise(F.col("country")),
                "first_name": F.when(k % 10 == 1, "NEWNAME").otherwise(F.col("first_name")),
            }
        )
        return first.filter(k % 97 != 1), second

    def customer_history(self, *dates: dt.date) -> DataFrame:
        return self._history(
            "dim_customers",
            zip(dates, self.customer_days()),
            "customer_id",
            gold.CUSTOMER_TRACKED,
            "customer_key",
            False,
        )

    def product_history(self) -> DataFrame:
        """Three deliveries: products appear, move, vanish and come back."""
        first = self.dim_products.withColumn("category_id", F.lit(None).cast("string"))
        k = F.col("product_key")
        later = first.withColumns(
            {
                "category": F.when(k % 10 == 0, "MOVED").otherwise(F.col("category")),
                "maintenance": F.when(k % 10 == 1, "NEW").otherwise(F.col("maintenance")),
            }
        )
        days = [
            (dt.date(2001, 1, 1), first.filter(k % 97 != 1)),
            (dt.date(2001, 2, 1), later.filter(k % 89 != 3)),
            (dt.date(2001, 3, 1), later),
        ]
        return self._history(
            "dim_products", days, "product_id", gold.PRODUCT_TRACKED, "product_key", True
        )

    def merged_sales(self) -> DataFrame:
        """All loadable sales merged into an older copy with other prices and dates."""
        stage = materialize(self.stage_sales("bronze_sales_unique"))  # read as both sides
        loadable, _ = gold.split_orphans(stage)
        n = F.substring("order_number", 3, 20).cast("long")
        target = loadable.filter(n % 5 != 0).withColumns(
            {
                "price": F.when(n % 7 == 0, F.coalesce("price", F.lit(0)) + 1)
                .otherwise(F.col("price"))
                .cast(schemas.MONEY),
                "order_date": F.when(n % 11 == 0, F.date_sub("order_date", 1)).otherwise(
                    F.col("order_date")
                ),
            }
        )
        return merge.upsert(
            target, loadable.filter(n % 13 != 0), gold.FACT_KEYS, gold.FACT_COMPARE, gold.FACT_SET
        )

    def keyed_sales(self) -> DataFrame:
        by = ["sls_ord_num", "sls_prd_key"]
        return assign_keys(self.bronze_sales_unique.select(*by), "sale_key", by, after=100)


def write_feed(df: DataFrame) -> str:
    folder = scratch_dir(df.sparkSession)
    (
        df.write.option("header", True)
        .option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return folder


def bronze_load(t: Tables) -> DataFrame:
    warehouse = Warehouse(t.spark, scratch_dir(t.spark), lambda: NOW)
    warehouse.load_bronze({"crm_sales_details": write_feed(t.bronze_sales_details)})
    return warehouse.load("bronze", "crm_sales_details")


class Days:
    """Noon of one day after another, the load times of a warehouse."""

    def __init__(self):
        self.day = dt.date(2001, 1, 1)

    def __call__(self) -> dt.datetime:
        return dt.datetime.combine(self.day, dt.time(12), dt.timezone.utc)


def deliver(t: Tables, w: Warehouse, days: Days, dim: str, deliveries: list[dict[str, DataFrame]]) -> DataFrame:
    """A dimension after deliveries on the first of one month after another, by the loads alone."""
    for month, feeds in enumerate(deliveries, 1):
        days.day = dt.date(2001, month, 1)
        w.load_bronze({name: write_feed(df) for name, df in feeds.items()})
        w.load_silver(list(feeds))
        w.load_dimensions([dim])
    return w.load("gold", dim)


def customer_deliveries(t: Tables) -> DataFrame:
    days = Days()
    w = Warehouse(t.spark, scratch_dir(t.spark), days)
    deliveries = [
        {"crm_cust_info": t.bronze_cust_info_day1, "erp_cust_az12": t.bronze_erp_cust, "erp_loc_a101": t.bronze_erp_loc},
        {"crm_cust_info": t.bronze_cust_info, "erp_loc_a101": t.bronze_erp_loc_day2},
        {"erp_loc_a101": t.bronze_erp_loc_day3},
    ]
    return deliver(t, w, days, "dim_customers", deliveries)


def product_deliveries(t: Tables) -> DataFrame:
    days = Days()
    w = Warehouse(t.spark, scratch_dir(t.spark), days)
    deliveries = [
        {"crm_prd_info": t.bronze_prd_info_day1, "erp_px_cat_g1v2": t.bronze_erp_cat},
        {"crm_prd_info": t.bronze_prd_info_day2},
        {"crm_prd_info": t.bronze_prd_info_day3},
    ]
    return deliver(t, w, days, "dim_products", deliveries)


def two_loads(t: Tables, named: bool = False) -> Warehouse:
    """All feeds, then the sales of a second day merged in by the loads alone.

    Names and reports are registered, if wanted, before the second day.
    """
    w = Warehouse(t.spark, scratch_dir(t.spark), lambda: NOW)
    w.load_all(t.feeds() | {"crm_sales_details": write_feed(t.bronze_sales_day1)})
    if named:
        w.register()
        w.register_reports(AS_OF, VIP_MONTHS, VIP_SALES, HIGH_SALES, MID_SALES)
    w.load_bronze({"crm_sales_details": write_feed(t.bronze_sales_day2)})
    w.load_silver(["crm_sales_details"])
    w.load_fact_sales()
    return w


def report_by_name(t: Tables, name: str) -> DataFrame:
    """A report as the catalog has it, after a load that came when it was there already."""
    two_loads(t, named=True)
    return t.spark.table(f"gold.{name}")


def repeat_load(t: Tables) -> DataFrame:
    """The fact after the same feeds came three times, and how many batches all tables have more for it."""

    def batches() -> int:
        w.vacuum()
        return sum(sum(table.parts().values()) for table in w.tables.values())

    feeds = t.feeds()
    w = Warehouse(t.spark, scratch_dir(t.spark), lambda: NOW)
    w.load_all(feeds)
    before = batches()
    w.load_all(feeds)
    w.load_all(feeds)
    return with_business_keys(w).withColumn("new_batches", F.lit(batches() - before).cast("long"))


def durations_of_layers(t: Tables) -> DataFrame:
    """Steps, rows and seconds of each layer of a full load, by a clock that goes on a second at each look."""
    looks = itertools.count()
    w = Warehouse(t.spark, scratch_dir(t.spark), lambda: NOW + dt.timedelta(seconds=next(looks)))
    w.load_all(t.feeds())
    log = w.log.read()
    rows = log.groupBy(F.split_part("procedure_name", F.lit("."), F.lit(1)).alias("layer")).agg(
        F.sum("rows_inserted").alias("rows_inserted")
    )
    return runlog.layer_durations(log).join(rows, "layer").select("layer", "steps", "layer_seconds", "rows_inserted")


def load_all(t: Tables) -> DataFrame:
    """Feeds to star schema, then the fact with business keys looked up again."""
    return with_business_keys(t.loaded())


def with_business_keys(w: Warehouse) -> DataFrame:
    fact = w.load("gold", "fact_sales")
    customers = join_side(w.load("gold", "dim_customers").select("customer_key", "customer_id"))
    products = join_side(w.load("gold", "dim_products").select("product_key", "product_id"))
    joined = fact.join(customers, "customer_key").join(products, "product_key")
    return joined.select(
        *"order_number product_number customer_id product_id date_key order_date".split(),
        *"sales_amount quantity price".split(),
    )


HISTORY = ["scd_start_date", "scd_end_date", "scd_is_current"]


def dim_date(t: Tables) -> DataFrame:
    """Order-day calendar with the days of later shipments merged in."""
    ends = t.fact_sales.select(F.explode(F.array("order_date", "shipping_date")).alias("day"))
    known = gold.calendar_of(t.fact_sales, "order_date")
    return merge.insert_missing(known, gold.calendar_of(ends, "day"), ["date_key"])


def fact_with_keys(t: Tables) -> DataFrame:
    return t.fact_sales.withColumns(
        {
            "product_number": F.col("product_key").cast("string"),
            "date_key": F.coalesce("order_date", "shipping_date", "due_date"),
        }
    )


def star(t: Tables) -> dict[str, DataFrame]:
    return {
        "dim_date": gold.calendar_of(t.fact_sales, "order_date"),
        "dim_customers": t.dim_customers,
        "dim_products": t.dim_products,
        "fact_sales": fact_with_keys(t),
    }


def table_list(t: Tables) -> DataFrame:
    testviews.register(t.spark, t.sf_dir, *STAR_NAMES)
    listed = list_tables(t.spark, STAR_NAMES, with_rows=True)
    return listed.select("table_name", "table_type", "table_rows")


def layer_tables(t: Tables) -> DataFrame:
    """The raw layer by name, after a load of all feeds."""
    warehouse = Warehouse(t.spark, scratch_dir(t.spark), lambda: NOW)
    feeds = t.feeds() | {"crm_sales_details": write_feed(t.bronze_sales_details)}
    warehouse.load_bronze(feeds)
    warehouse.register()
    listed = list_tables(t.spark, list(feeds), with_rows=True, schemas=["bronze"])
    return listed.select("table_schema", "table_name", "table_rows")


def rejected_rows(t: Tables) -> DataFrame:
    """A feed in which part of the lines has a word for a number: read, set aside, put together again."""
    raw = t.bronze_sales_details
    spoiled = F.when(F.col("sls_quantity") % 7 == 3, F.lit("many")).otherwise(F.col("sls_quantity").cast("string"))
    warehouse = Warehouse(t.spark, scratch_dir(t.spark), lambda: NOW)
    warehouse.load_bronze({"crm_sales_details": write_feed(raw.withColumn("sls_quantity", spoiled))})
    lines = warehouse.table("bronze", "crm_sales_details").read()
    fields = F.size(F.split(REJECT, ","))
    return lines.agg(
        F.count("*").alias("lines_read"),
        F.count(REJECT).alias("rejected"),
        F.count_if((fields == len(raw.columns)) & F.col(REJECT).contains(",many,")).alias("rebuilt"),
    )


STAR_NAMES = ["dim_customers", "dim_products", "fact_sales"]
LOG_COLUMNS = "log_id procedure_name rows_inserted rows_updated rows_expired status error_message"

PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    # cleaning
    "bronze_load": bronze_load,
    "silver_cust_info": lambda t: t.silver_customers(),
    "silver_prd_info": lambda t: t.silver_products(),
    "silver_sales_details": lambda t: silver.clean_crm_sales_details(t.bronze_sales_details),
    "silver_erp_cust": lambda t: silver.clean_erp_cust_az12(t.bronze_erp_cust, AS_OF),
    "silver_erp_loc": lambda t: silver.clean_erp_loc_a101(t.bronze_erp_loc),
    "silver_erp_cat": lambda t: silver.clean_erp_px_cat_g1v2(t.bronze_erp_cat),
    # star schema
    "gold_dim_date": dim_date,
    "gold_stage_customers": lambda t: t.stage_customers(),
    "gold_scd_customers": lambda t: t.customer_history(
        dt.date(2001, 1, 1), dt.date(2001, 2, 1)
    ).select("customer_id", "first_name", "country", "gender", *HISTORY),
    "gold_stage_products": lambda t: t.stage_products(),
    "gold_scd_products": lambda t: t.product_history().select(
        "product_id", "category", "maintenance", "cost", *HISTORY
    ),
    "gold_stage_sales": lambda t: t.stage_sales(),
    "gold_orphans": lambda t: gold.split_orphans(t.stage_sales())[1],
    "gold_date_backfill": lambda t: gold.backfill_dates(
        gold.calendar_of(t.fact_sales, "order_date"), t.fact_sales, "shipping_date"
    ),
    "gold_surrogate_keys": lambda t: t.keyed_sales(),
    "gold_fact_merge": lambda t: t.merged_sales().select(
        *gold.FACT_KEYS, *gold.FACT_COMPARE, "order_date", merge.ACTION
    ),
    "gold_load_all": load_all,
    "gold_second_load": lambda t: with_business_keys(two_loads(t)),
    "gold_repeat_load": repeat_load,
    "gold_second_dim_customers": lambda t: customer_deliveries(t).select(
        "customer_id", "first_name", "country", "marital_status", "gender", "birthdate", *HISTORY
    ),
    "gold_second_dim_products": lambda t: product_deliveries(t).select(
        "product_id", "product_number", "category", "cost", "product_line", *HISTORY
    ),
    # exploration
    "eda_tables": table_list,
    "eda_columns": lambda t: list_columns(t.dim_customers, with_nulls=True),
    "eda_countries": lambda t: explore.countries(t.dim_customers),
    "eda_product_tree": lambda t: explore.product_tree(t.dim_products),
    "eda_order_range": lambda t: explore.order_range(t.fact_sales),
    "eda_age_range": lambda t: explore.age_range(t.dim_customers, AS_OF),
    "eda_total_sales": lambda t: explore.total_sales(t.fact_sales),
    "eda_total_quantity": lambda t: explore.total_quantity(t.fact_sales),
    "eda_avg_price": lambda t: explore.average_price(t.fact_sales),
    "eda_order_rows": lambda t: explore.order_rows(t.fact_sales),
    "eda_orders": lambda t: explore.orders(t.fact_sales),
    "eda_products": lambda t: explore.product_count(t.dim_products),
    "eda_customers": lambda t: explore.customer_count(t.dim_customers),
    "eda_buying_customers": lambda t: explore.buying_customers(t.fact_sales),
    "eda_key_metrics": lambda t: explore.key_metrics(
        t.fact_sales, t.dim_customers, t.dim_products
    ),
    "mag_customers_by_country": lambda t: explore.members_by(
        t.dim_customers, "country", "customer_key", "total_customers"
    ),
    "mag_customers_by_gender": lambda t: explore.members_by(
        t.dim_customers, "gender", "customer_key", "total_customers"
    ),
    "mag_products_by_category": lambda t: explore.members_by(
        t.dim_products, "category", "product_key", "total_products"
    ),
    "mag_avg_cost_by_category": lambda t: explore.average_cost_by_category(t.dim_products),
    "mag_revenue_by_category": lambda t: explore.revenue_by_category(t.fact_sales, t.dim_products),
    "mag_revenue_by_customer": lambda t: explore.revenue_by_customer(
        t.fact_sales, t.dim_customers
    ),
    "mag_items_by_country": lambda t: explore.items_by_country(t.fact_sales, t.dim_customers),
    "rank_top5_products": lambda t: explore.top_products(t.fact_sales, t.dim_products),
    "rank_top5_products_window": lambda t: explore.top_products_ranked(
        t.fact_sales, t.dim_products
    ),
    "rank_bottom5_products": lambda t: explore.bottom_products(t.fact_sales, t.dim_products),
    "rank_top10_customers": lambda t: explore.top_customers(t.fact_sales, t.dim_customers),
    "rank_bottom3_customers": lambda t: explore.least_active_customers(
        t.fact_sales, t.dim_customers
    ),
    # trends and segments
    "trend_year_month": lambda t: analytics.trend_by_year_month(t.fact_sales),
    "trend_month_trunc": lambda t: analytics.trend_by_period(t.fact_sales),
    "trend_month_label": lambda t: analytics.trend_by_label(t.fact_sales),
    "cumulative_sales": lambda t: analytics.cumulative_sales(t.fact_sales),
    "performance_yoy": lambda t: analytics.performance_by_year(t.fact_sales, t.dim_products),
    "segment_products_by_cost": lambda t: analytics.products_by_cost(t.dim_products),
    "segment_customers": lambda t: analytics.customers_by_segment(
        t.fact_sales, t.dim_customers, VIP_MONTHS, VIP_SALES
    ),
    "part_to_whole": lambda t: analytics.category_share(t.fact_sales, t.dim_products),
    "report_customers": lambda t: reports.report_customers(
        t.fact_sales, t.dim_customers, AS_OF, VIP_MONTHS, VIP_SALES
    ),
    "report_products": lambda t: reports.report_products(
        t.fact_sales, t.dim_products, AS_OF, HIGH_SALES, MID_SALES
    ),
    "report_view_customers": lambda t: report_by_name(t, "report_customers").drop("customer_key"),
    "report_view_products": lambda t: report_by_name(t, "report_products").drop("product_key"),
    # checks
    "dq_layer_durations": durations_of_layers,
    "dq_row_counts": lambda t: quality.row_counts(star(t)),
    "dq_load_log_tail": lambda t: quality.log_tail(t.loaded().log.read()).select(
        *LOG_COLUMNS.split()
    ),
    "dq_load_log_changes": lambda t: two_loads(t).log.read().where("log_id > 16").select(*LOG_COLUMNS.split()),
    "dq_orphan_customers": lambda t: quality.unresolved_customers(
        t.stage_sales(), t.stage_customers().select(F.col("customer_id").alias("customer_key"))
    ),
    "dq_scd_current_unique": lambda t: quality.current_not_unique(
        t.bronze_cust_info.select(
            F.col("cst_id").alias("customer_id"), F.lit(True).alias("scd_is_current")
        ),
        "customer_id",
    ),
    "dq_layer_tables": layer_tables,
    "dq_rejected_rows": rejected_rows,
    "dq_primary_key": lambda t: quality.primary_key_faults(star(t)),
    "dq_foreign_key": lambda t: quality.foreign_key_faults(star(t)),
    "dq_not_null": lambda t: quality.not_null_faults(
        {
            "fact_sales": t.stage_sales(),
            "dim_customers": t.bronze_cust_info.select(F.col("cst_id").alias("customer_id")),
            "dim_products": t.dim_products,
            "dim_date": star(t)["dim_date"],
        }
    ),
    "dq_bad_dates": lambda t: silver.bad_sales_dates(t.bronze_sales_details),
    "dq_scd_ranges": lambda t: quality.period_faults(
        {
            "dim_customers": (
                t.customer_history(dt.date(2001, 1, 1), dt.date(2001, 1, 1)),
                "customer_id",
            )
        }
    ).select(F.col("version_key").alias("customer_id"), *HISTORY),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: revenue by product category."""
    return queries()["mag_revenue_by_category"](spark, "/root/testdata/sf0.001")


def optional_parts() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators, where that subpackage is installed."""
    found: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for name in ("tallyhouse.llm.queries", "corpus_pipeline"):
        try:
            part = importlib.import_module(name)
        except ModuleNotFoundError as error:
            # the other queries do without; a package that a part needs is named
            if error.name != "corpus_pipeline" and not (error.name or "").startswith("tallyhouse.llm"):
                warnings.warn(f"{name} is left out: {error}", stacklevel=2)
            continue
        found.update(part.QUERIES)
        sql.update({key: text for key, text in part.ORACLES.items() if text})
    return found, sql


def queries() -> dict[str, Query]:
    def bind(plan: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, sf_dir: plain(plan(Tables(spark, sf_dir)))

    return {key: bind(plan) for key, plan in PLANS.items()} | optional_parts()[0]


def oracle_sql() -> dict[str, str]:
    return oracle() | optional_parts()[1]
