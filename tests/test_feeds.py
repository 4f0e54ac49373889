import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.catalog import ensure_layers, list_columns, list_tables
from tallyhouse.sources.feeds import REJECT, read_feed, split
from tallyhouse.sources.snapshots import empty_table


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


HEADER = "these,names,are,not,used,at,all"


def test_feed_is_bound_by_position_and_keeps_blanks(spark, tmp_path):
    path = write(
        tmp_path / "p.csv", HEADER, "1,AC-HE-X1,Helmet,12,S ,2011-07-01,2007-12-28", "2,,,,,,"
    )
    rows = read_feed(spark, path, schemas.BRONZE["crm_prd_info"]).orderBy("prd_id").collect()
    assert rows[0].prd_line == "S "
    assert rows[0].prd_start_dt == dt.datetime(2011, 7, 1)
    assert rows[1].prd_key is None and rows[1].prd_cost is None
    assert [r[REJECT] for r in rows] == [None, None]


def test_unreadable_rows_are_set_aside(spark, tmp_path):
    path = write(
        tmp_path / "s.csv",
        HEADER,
        "SO1,P1,1,20130101,20130102,20130103,10,1,10",
        "SO2,P1,one,20130101,20130102,20130103,10,1,10",  # not a number
        "SO3,P1,1",  # fields missing
        f"{'S' * 51},P1,1,20130101,20130102,20130103,10,1,10",  # text too long
    )
    feed = read_feed(spark, path, schemas.BRONZE["crm_sales_details"])
    good, bad = split(feed, F.col(REJECT).isNotNull())
    assert [r.sls_ord_num for r in good.collect()] == ["SO1"]
    assert {r[REJECT].split(",")[0][:3] for r in bad.collect()} == {"SO2", "SO3", "SSS"}


def test_raw_line_keeps_its_fields_and_numbers_may_have_blanks(spark, tmp_path):
    long = "L" * 51
    path = write(
        tmp_path / "r.csv",
        HEADER,
        "SO2,P1, 12 , 20130101,20130102,20130103,10,1,10",
        f"{long},,1,20130101,,20130103,10,1,10",
        'SO4,"a,b",x,20130101,20130102,20130103,10,1,10',
    )
    rows = {r.sls_ord_num[:3]: r for r in read_feed(spark, path, schemas.BRONZE["crm_sales_details"]).collect()}
    assert rows["SO2"].sls_cust_id == 12 and rows["SO2"].sls_order_dt == 20130101 and rows["SO2"][REJECT] is None
    assert rows["LLL"][REJECT] == f"{long},,1,20130101,,20130103,10,1,10"
    assert rows["SO4"][REJECT] == 'SO4,"a,b",x,20130101,20130102,20130103,10,1,10'


def test_rejects_have_no_limit_unless_asked_for(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh"))
    bad = write(tmp_path / "bad.csv", "cid,cntry", "AW-2,US", *["x"] * 40)
    w.load_bronze({"erp_loc_a101": bad})
    assert w.rejects("erp_loc_a101").count() == 40
    with pytest.raises(ValueError, match="40 of 41 rows unreadable"):
        w.load_bronze({"erp_loc_a101": bad}, max_reject_share=0.5)


def test_reject_limit_keeps_the_old_table(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh"))
    good = write(tmp_path / "good.csv", "cid,cntry", "AW-1,DE")
    bad = write(tmp_path / "bad.csv", "cid,cntry", "AW-2,US", *["x"] * 3)
    w.load_bronze({"erp_loc_a101": good})
    with pytest.raises(ValueError, match="3 unreadable rows, 2 allowed"):
        w.load_bronze({"erp_loc_a101": bad}, max_rejects=2)
    assert [r.cid for r in w.load("bronze", "erp_loc_a101").collect()] == ["AW-1"]
    w.load_bronze({"erp_loc_a101": bad}, max_rejects=3)
    assert [r.cid for r in w.load("bronze", "erp_loc_a101").collect()] == ["AW-2"]
    assert w.rejects("erp_loc_a101").count() == 3
    log = w.log.read().orderBy("log_id").collect()
    assert [r.status for r in log] == ["SUCCESS", "FAILED", "SUCCESS"]
    assert log[2].error_message == "Rows rejected: 3"


def test_catalog(spark):
    people = empty_table(spark, schemas.GOLD["dim_customers"])
    people.createOrReplaceTempView("catalog_people")
    listed = list_tables(spark, ["catalog_people"]).first()
    assert (listed.table_name, listed.table_type) == ("catalog_people", "VIEW")
    counted = list_tables(spark, ["catalog_people"], with_rows=True).collect()
    assert [r.table_rows for r in counted] == [0]
    columns = {r.column_name: r for r in list_columns(people).collect()}
    assert columns["gender"].character_maximum_length == 10
    assert columns["customer_key"].data_type == "bigint"
    assert {r.null_rows for r in list_columns(people, with_nulls=True).collect()} == {0}


def test_layers(spark):
    ensure_layers(spark)
    names = {d.name for d in spark.catalog.listDatabases()}
    assert set(schemas.LAYERS) <= names
