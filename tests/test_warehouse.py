import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyhouse import schemas
from tallyhouse.operators import merge
from tallyhouse.plans import gold, quality, reports
from tallyhouse.plans.runlog import with_duration
from tallyhouse.plans.warehouse import Warehouse

UTC = dt.timezone.utc
LINES = {
    "crm_cust_info": [
        "1,AW1, Ann,Lee ,S,F,2020-01-01",
        "1,AW1,Ann,Lee,M,F,2020-02-01",
        "2,AW2,Bob,Ray,M,,2020-01-01",
        ",AW9,ghost,row,S,M,2020-01-01",
    ],
    "crm_prd_info": [
        "10,AC-HE-H1,Helmet,12,S ,2011-07-01,2007-12-28",
        "11,AC-HE-H1,Helmet,14,S ,2012-07-01,",
        "12,BI-RB-B1,Bike,,R,2011-07-01,",
    ],
    "crm_sales_details": [
        "SO1,H1,1,20130101,20130105,20130110,28,2,14",
        "SO1,B1,1,20130101,20130105,20130110,500,1,500",
        "SO2,B1,2,0,20140105,20140110,500,1,500",  # no order date: shipping date counts
        "SO3,B1,99,20130101,20130105,20130110,500,1,500",  # no such customer
        "SO4,XX,1,20130101,20130105,20130110,500,1,500",  # no such product
        "SO5,B1,1,0,,20131332,500,1,500",  # no date at all
        "SO6,H1,2,19991231,20000105,20000110,14,1,14",  # before the calendar starts
    ],
    "erp_cust_az12": ["NASAW1,1980-05-05,Male", "AW2,2090-01-01,M"],
    "erp_loc_a101": ["AW-1,DE", "AW-2, "],
    "erp_px_cat_g1v2": ["AC_HE,Accessories,Helmets,Yes"],
}


class Clock:
    def __init__(self):
        self.now = dt.datetime(2020, 1, 1, 8, tzinfo=UTC)

    def __call__(self):
        self.now += dt.timedelta(seconds=1)
        return self.now


@pytest.fixture
def house(spark, tmp_path):
    clock = Clock()
    w = Warehouse(spark, str(tmp_path / "wh"), clock)

    def feeds(**changed):
        paths = {}
        for name, lines in {**LINES, **changed}.items():
            path = tmp_path / f"{name}-{clock.now:%Y%m%d%H%M%S}.csv"
            header = ",".join(schemas.BRONZE[name].names)
            path.write_text("\n".join([header, *lines]) + "\n")
            paths[name] = str(path)
        return paths

    return w, clock, feeds


def facts(w):
    rows = w.load("gold", "fact_sales").collect()
    return {(r.order_number, r.product_number): r for r in rows}


def test_feeds_to_star_and_back_again(house, spark):
    w, clock, feeds = house
    w.load_all(feeds())
    fact = facts(w)
    assert set(fact) == {("SO1", "H1"), ("SO1", "B1"), ("SO2", "B1"), ("SO6", "H1")}
    assert fact["SO2", "B1"].date_key == dt.date(2014, 1, 5)
    assert w.load("gold", "fact_sales", ["2013"]).count() == 2
    log = {r.procedure_name: r for r in w.log.read().collect()}
    assert len(log) == 16 and {r.status for r in log.values()} == {"SUCCESS"}
    assert log["gold.load_fact_sales"].rows_inserted == 4
    assert log["gold.load_fact_sales"].error_message == "Orphan rows skipped: 3"
    assert log["silver.crm_sales_details"].error_message == "Dates set to NULL: 1"
    assert log["gold.load_dim_date"].rows_inserted == 11323
    assert with_duration(w.log.read()).filter("duration_seconds < 0").count() == 0

    people = {r.customer_id: r for r in w.load("gold", "dim_customers").collect()}
    assert (people[1].country, people[1].marital_status, people[1].gender) == (
        "Germany",
        "Married",
        "Female",
    )
    assert (people[2].country, people[2].gender, people[2].birthdate) == (None, "Male", None)
    goods = {r.product_id: r for r in w.load("gold", "dim_products").collect()}
    assert set(goods) == {11, 12} and goods[12].category is None

    tables = {name: w.load("gold", name) for name in schemas.GOLD if name != "dw_load_log"}
    assert quality.foreign_key_faults(tables).count() == 0  # 1999 was added to the calendar
    assert quality.primary_key_faults(tables).count() == 0
    assert quality.not_null_faults(tables).count() == 0
    assert tables["dim_date"].count() == 11324

    # the same feeds once more: not one row moves, no fact or dimension is written
    before = {n: w.table("gold", n).version() for n in ("dim_customers", "dim_products", "fact_sales")}
    clock.now += dt.timedelta(days=40)
    w.load_all(feeds())
    again = w.log.read().filter("log_id > 28").collect()
    assert all((r.rows_inserted, r.rows_updated, r.rows_expired) == (0, 0, 0) for r in again)
    assert {n: w.table("gold", n).version() for n in before} == before

    # reports over loaded facts need no orphan lookup
    fact_df, dim = tables["fact_sales"], tables["dim_customers"]
    as_of = dt.date(2020, 1, 1)
    full = reports.report_customers(fact_df, dim, as_of).collect()
    short = reports.report_customers(fact_df, dim, as_of, keys_resolved=True).collect()
    assert sorted(full) == sorted(short) and len(full) == 2


def test_changes_flow_through(house):
    w, clock, feeds = house
    w.load_all(feeds())
    old = facts(w)
    files_2014 = set(w.table("gold", "fact_sales").read(["2014"]).inputFiles())
    clock.now += dt.timedelta(days=31)
    sales = [
        "SO1,H1,1,20120601,20130105,20130110,30,2,15",  # price differs, moves to 2012
        "SO1,B1,1,20150101,20130105,20130110,500,1,500",  # only the date differs: stays
        *LINES["crm_sales_details"][2:],
        "SO7,B1,2,20160101,20160105,20160110,500,1,500",  # new
    ]
    w.load_all(
        feeds(
            crm_sales_details=sales,
            erp_loc_a101=["AW-1,FR", "AW-2, "],
            crm_prd_info=LINES["crm_prd_info"][:2],  # product 12 vanished
        )
    )
    log = {r.procedure_name: r for r in w.log.read().filter("log_id > 16").collect()}
    assert (log["gold.load_dim_customers"].rows_inserted, log["gold.load_dim_customers"].rows_expired) == (1, 1)
    assert (log["gold.load_dim_products"].rows_inserted, log["gold.load_dim_products"].rows_expired) == (0, 1)
    done = log["gold.load_fact_sales"]
    # B1 has no open version any more, so only H1 of SO1 can be merged
    assert (done.rows_inserted, done.rows_updated) == (0, 1)
    new = facts(w)
    assert set(new) == set(old)
    moved = new["SO1", "H1"]
    assert (moved.date_key, moved.price) == (dt.date(2012, 6, 1), 15)
    assert moved.dw_insert_date == old["SO1", "H1"].dw_insert_date
    assert moved.customer_key != old["SO1", "H1"].customer_key  # the new version of customer 1
    assert new["SO1", "B1"] == old["SO1", "B1"]
    # years without an update keep their files
    assert set(w.table("gold", "fact_sales").read(["2014"]).inputFiles()) == files_2014
    dim = w.load("gold", "dim_customers")
    assert quality.current_not_unique(dim, "customer_id").count() == 0
    assert dim.filter(F.col("customer_id") == 1).count() == 2


def test_a_failed_step_is_logged_and_leaves_the_old_state(house):
    w, clock, feeds = house
    w.load_all(feeds())
    before = facts(w)
    w.fact_keys = gold.FACT_KEYS  # without the line number
    twice = [*LINES["crm_sales_details"], LINES["crm_sales_details"][0]]
    with pytest.raises(Exception, match="merge source: repeated or missing key"):
        w.load_all(feeds(crm_sales_details=twice))
    assert facts(w) == before
    last = quality.log_tail(w.log.read(), 1).first()
    assert (last.procedure_name, last.status) == ("gold.load_fact_sales", "FAILED")
    assert "repeated or missing key" in last.error_message


def batches(w, name):
    """Part to the batches it lies in."""
    found = {}
    for part, batch in w.table("gold", name).log.pairs():
        found.setdefault(part, set()).add(batch)
    return found


def many(count):
    people = [f"{k},AW{k},Ann,Lee,S,F,2020-01-01" for k in range(1, count + 1)]
    lines = [f"SO{k},H1,{k},2013{k % 12 + 1:02d}01,20130105,20130110,28,2,14" for k in range(1, count + 1)]
    return people, lines


def test_one_changed_line_rewrites_one_bucket(house):
    w, clock, feeds = house
    people, lines = many(60)
    w.load_all(feeds(crm_cust_info=people, crm_sales_details=lines))
    before, rows = batches(w, "fact_sales"), w.load("gold", "fact_sales").count()
    assert len(before) == 8 and all(p.startswith("2013.") for p in before)
    lines[10] = lines[10].replace(",28,2,14", ",42,3,14")
    w.load_bronze({"crm_sales_details": feeds(crm_sales_details=lines)["crm_sales_details"]})
    w.load_silver(["crm_sales_details"])
    w.load_fact_sales()
    after = batches(w, "fact_sales")
    changed = [p for p in before if after[p] != before[p]]
    assert len(changed) == 1 and set(after) == set(before) and not after[changed[0]] & before[changed[0]]
    assert w.load("gold", "fact_sales").count() == rows
    assert w.load("gold", "fact_sales").where("quantity = 3").count() == 1
    # a new line adds files to its bucket and rewrites none
    w.load_bronze({"crm_sales_details": feeds(crm_sales_details=["SO99,H1,1,20130101,20130105,20130110,28,2,14"])["crm_sales_details"]})
    w.load_silver(["crm_sales_details"])
    w.load_fact_sales()
    added = batches(w, "fact_sales")
    assert sum(added[p] != after[p] for p in after) == 1 and all(added[p] >= after[p] for p in after)
    assert w.load("gold", "fact_sales").count() == rows + 1


def test_one_moved_customer_rewrites_one_bucket(house):
    w, clock, feeds = house
    people, _ = many(60)
    w.load_all(feeds(crm_cust_info=people))
    before = batches(w, "dim_customers")
    assert len(before) == 8
    clock.now += dt.timedelta(days=31)
    people[7] = people[7].replace(",S,F,", ",M,F,")
    w.load_bronze({"crm_cust_info": feeds(crm_cust_info=people)["crm_cust_info"]})
    w.load_silver(["crm_cust_info"])
    w.load_dimensions(["dim_customers"])
    after = batches(w, "dim_customers")
    assert set(after) - set(before) == {"past"}
    assert sum(after[p] != before[p] for p in before) == 1
    assert w.load("gold", "dim_customers").count() == 61 and w.load("gold", "dim_customers", ["current"]).count() == 60


def test_repeated_products_of_an_order_are_lines_of_their_own(house):
    w, clock, feeds = house
    sales = ["SO1,H1,1,20130101,20130105,20130110,28,2,14"] * 2 + ["SO1,H1,1,20130101,20130105,20130110,14,1,14"]
    w.load_all(feeds(crm_sales_details=sales))
    fact = w.load("gold", "fact_sales")
    assert sorted((r.line_number, r.quantity) for r in fact.collect()) == [(1, 1), (2, 2), (3, 2)]
    assert quality.primary_key_faults({"fact_sales": fact}).count() == 0
    version = w.table("gold", "fact_sales").version()
    w.load_all(feeds(crm_sales_details=sales))
    assert w.table("gold", "fact_sales").version() == version


def test_loads_broadcast_no_dimension_that_only_packs_well(spark, tmp_path, monkeypatch):
    """Of tables with small files but many rows, none is built whole in the driver: neither in loads nor in reports."""
    people = 4000
    feeds = {
        "crm_cust_info": [f"{i},AW{i},Ann,Lee,S,F,2020-01-01" for i in range(people)],
        "crm_prd_info": [f"{i},AC-HE-P{i},Helmet,12,S ,2011-07-01," for i in range(people)],
        "crm_sales_details": [f"SO{i},P{i},{i},20130101,20130105,20130110,28,2,14" for i in range(people)],
        "erp_cust_az12": [f"AW{i},1980-05-05,Male" for i in range(people)],
        "erp_loc_a101": [f"AW{i},DE" for i in range(people)],
        "erp_px_cat_g1v2": ["AC_HE,Accessories,Helmets,Yes"],
    }
    paths = {}
    for name, lines in feeds.items():
        paths[name] = str(tmp_path / f"{name}.csv")
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(schemas.BRONZE[name].names), *lines]) + "\n")
    plans = {}

    def watch(module, name):
        real = getattr(module, name)

        def watched(*args, **kwargs):
            made = real(*args, **kwargs)
            plans[name] = made._jdf.queryExecution().sparkPlan().toString()
            return made

        monkeypatch.setattr(module, name, watched)

    for module, name in [(gold, "stage_customers"), (gold, "stage_sales"), (merge, "merge_delta")]:
        watch(module, name)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    w = Warehouse(spark, str(tmp_path / "wh"), Clock())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        w.load_all(paths)
        changed = [line.replace(",28,2,14", ",42,3,14") for line in feeds["crm_sales_details"]]
        with open(paths["crm_sales_details"], "w") as feed:
            feed.write("\n".join([",".join(schemas.BRONZE["crm_sales_details"].names), *changed]) + "\n")
        w.load_bronze({"crm_sales_details": paths["crm_sales_details"]})
        w.load_silver(["crm_sales_details"])
        w.load_fact_sales()
        w.register()
        w.register_reports(dt.date(2020, 1, 1))
        for name in ("report_customers", "report_products"):
            plans[name] = spark.table(f"gold.{name}")._jdf.queryExecution().sparkPlan().toString()
        plans["business keys"] = entry.with_business_keys(w)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    large = "_cid|_loc_cid|product_number|customer_id|order_number|customer_key|product_key"
    built = re.compile(rf"BroadcastHashJoin \[[^]]*\], \[({large})#")
    assert len(plans) == 6
    assert {name: found for name, plan in plans.items() if (found := built.findall(plan))} == {}
    assert {r.quantity for r in w.load("gold", "fact_sales").collect()} == {3}
    assert w.load("gold", "fact_sales").count() == people
