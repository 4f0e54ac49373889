"""Upkeep of published tables, views by name, and layer times."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.plans import reports, runlog, silver
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.catalog import list_tables
from tallyhouse.sources.names import TableName
from tallyhouse.sources.snapshots import SnapshotTable

NOW = dt.datetime(2020, 5, 1, 12, tzinfo=dt.timezone.utc)
FEEDS = {
    "crm_cust_info": "1,AW1,Ann,Lee,S,F,2020-01-01",
    "crm_prd_info": "1,AC-HE-P1,Helmet,12,S,2011-07-01,",
    "crm_sales_details": "SO1,P1,1,20130101,20130102,20130103,24,2,12",
    "erp_cust_az12": "NASAW1,1980-01-01,Female",
    "erp_loc_a101": "AW-1,DE",
    "erp_px_cat_g1v2": "AC_HE,Accessories,Helmets,Yes",
}


@pytest.fixture
def numbers(spark, tmp_path):
    schema = spark.range(0).withColumn("kind", F.lit("")).schema
    return SnapshotTable(spark, str(tmp_path / "numbers"), schema, F.col("kind"))


def rows(spark, *ids, kind="a"):
    return spark.createDataFrame([(i, kind) for i in ids], "id long, kind string")


def ids(table):
    return sorted(r.id for r in table.read().collect())


def test_vacuum_keeps_live_batches_of_any_age(spark, numbers):
    numbers.append(rows(spark, 1, kind="old"))
    numbers.append(rows(spark, 2))
    numbers.rewrite(rows(spark, 3), ["a"])
    assert numbers.vacuum(keep_versions=2) == 0
    assert numbers.vacuum() == 1
    assert ids(numbers) == [1, 3]
    assert numbers.vacuum() == 0
    with pytest.raises(ValueError, match="has to stay"):
        numbers.vacuum(0)


def test_compact_merges_batches(spark, numbers):
    for i in range(4):
        numbers.append(rows(spark, i))
    assert numbers.compact(most_batches=4) == []
    assert numbers.compact(most_batches=2) == ["a"]
    assert numbers.vacuum() == 4 and ids(numbers) == [0, 1, 2, 3]


def test_the_log_is_read_from_the_last_whole_version(spark, numbers):
    for i in range(12):
        numbers.append(rows(spark, i, kind=f"k{i % 3}"))
    numbers.rewrite(rows(spark, 100), ["k0"])
    read = numbers.log._rows().inputFiles()
    assert len(read) == 4  # 10 to 13
    assert ids(numbers) == [i for i in range(12) if i % 3] + [100]
    assert sorted(set(p for p, _ in numbers.log.pairs(11))) == ["k0", "k1", "k2"] and len(numbers.log.pairs(11)) == 11
    assert numbers.vacuum(keep_versions=2) == 0 and numbers.vacuum() == 4
    assert numbers.log.newest() == 13 and len(numbers.log._files()[0]) == 4
    numbers.replace(rows(spark, 1))
    assert len(numbers.log._rows().inputFiles()) == 1 and ids(numbers) == [1]
    assert numbers.vacuum() > 0 and len(numbers.log._files()[0]) == 1


def test_a_lost_mark_of_a_whole_version_changes_nothing(spark, numbers):
    numbers.append(rows(spark, 1))
    numbers.replace(rows(spark, 2))
    numbers.append(rows(spark, 3))
    (Path(numbers.folder) / "_versions" / "v0000000002.whole").unlink()
    assert ids(numbers) == [2, 3] and len(numbers.log._rows().inputFiles()) == 3


def test_an_empty_append_publishes_nothing(spark, numbers):
    numbers.append(rows(spark, 1))
    before = numbers.version()
    numbers.append(rows(spark, 1).limit(0))
    assert numbers.version() == before and ids(numbers) == [1]


def test_a_second_writer_is_noticed(spark, numbers):
    def meanwhile(written):
        SnapshotTable(spark, numbers.folder, numbers.schema, numbers.part).append(rows(spark, 2))

    with pytest.raises(RuntimeError, match="came up while"):
        numbers.replace(rows(spark, 1), meanwhile)
    assert ids(numbers) == [2]


@pytest.fixture
def house(spark, tmp_path):
    paths = {}
    for name, line in FEEDS.items():
        path = tmp_path / f"{name}.csv"
        path.write_text("header\n" + line + "\n")
        paths[name] = str(path)
    w = Warehouse(spark, str(tmp_path / "house"), lambda: NOW)
    w.load_all(paths, start=dt.date(2013, 1, 1), end=dt.date(2013, 1, 31))
    return w, paths


def test_tables_and_reports_by_name(spark, house):
    w, paths = house
    w.register()
    w.register_reports(dt.date(2020, 5, 1))
    fact = spark.sql(
        "SELECT f.sales_amount, p.product_name FROM gold.fact_sales f JOIN gold.dim_products p USING (product_key)"
    )
    assert [(int(r.sales_amount), r.product_name) for r in fact.collect()] == [(24, "Helmet")]
    listed = {(r.table_schema, r.table_name): r.table_rows for r in list_tables(spark, with_rows=True, schemas=list(schemas.LAYERS)).collect()}
    assert listed["gold", "dim_date"] == 31 and listed["bronze", "erp_loc_a101"] == 1
    assert listed["gold", "dw_load_log"] == 16 and listed["gold", "report_customers"] == 1
    assert len([k for k in listed if k[0] == "silver"]) == len(schemas.SILVER)


def append_line(path, line):
    with open(path, "a") as feed:
        feed.write(line + "\n")


def test_names_follow_the_loads(spark, house):
    w, paths = house
    w.register()
    w.register_reports(dt.date(2020, 5, 1))
    assert spark.table("gold.report_products").count() == 1
    append_line(paths["crm_cust_info"], "2,AW2,Bob,Roy,M,M,2020-01-01")
    append_line(paths["crm_cust_info"], "x,AW3,no,number,M,M,2020-01-01")
    append_line(paths["crm_sales_details"], "SO2,P1,2,20130104,20130105,20130106,36,3,12")
    w.load_all(paths, start=dt.date(2013, 1, 1), end=dt.date(2013, 2, 28))
    assert w.vacuum() > 0
    for layer, layout in schemas.LAYERS.items():
        for name in layout:
            if name != "dw_load_log":
                by_name, loaded = spark.table(f"{layer}.{name}"), w.load(layer, name)
                assert by_name.columns == loaded.columns
                assert by_name.exceptAll(loaded).count() == loaded.exceptAll(by_name).count() == 0, name
    assert spark.table("bronze.crm_cust_info").count() == 2
    assert spark.table("gold.dim_date").count() == 59 and spark.table("gold.dw_load_log").count() == 32
    fact = w.load("gold", "fact_sales")
    for name, build in (("customers", reports.report_customers), ("products", reports.report_products)):
        expected = build(fact, w.load("gold", f"dim_{name}"), dt.date(2020, 5, 1), keys_resolved=True)
        seen = spark.table(f"gold.report_{name}")
        assert seen.columns == expected.columns
        assert sorted(map(tuple, seen.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert spark.table("gold.report_customers").count() == 2


def test_names_show_live_files_only(spark, numbers):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    spark.sql("CREATE DATABASE IF NOT EXISTS silver")
    name = TableName(spark, numbers, "silver", "numbers")
    name.create()
    assert spark.table("silver.numbers").count() == 0
    numbers.append(rows(spark, 1, kind="it's"))
    numbers.append(rows(spark, 2))
    # a version that the name was not told about, and a write that never became one
    assert spark.table("silver.numbers").count() == 0
    with pytest.raises(ValueError, match="refused"):
        numbers.replace(rows(spark, 9), refuse)
    name.follow()
    assert sorted(r.id for r in spark.table("silver.numbers").collect()) == [1, 2]
    numbers.on_publish = name.follow
    numbers.rewrite(rows(spark, 3), ["a"])
    seen = spark.table("silver.numbers")
    assert sorted(r.id for r in seen.collect()) == [1, 3] and len(seen.inputFiles()) == 2
    # between the new partitions and the new view readers see the old version
    numbers.on_publish = None
    numbers.append(rows(spark, 4))
    part, batch = max(numbers.log.pairs(), key=lambda pair: pair[1])
    spark.sql(f"ALTER TABLE published.silver_numbers ADD PARTITION (part='{part}', batch='{batch}')")
    assert spark.table("silver.numbers").count() == 2
    name.follow()
    assert spark.table("silver.numbers").count() == 3


def refuse(written):
    raise ValueError("refused")


def files_of(folder):
    return sum(1 for path in folder.rglob("*.parquet"))


def test_equal_loads_leave_no_growth(spark, house, tmp_path):
    w, paths = house
    w.vacuum()
    tables = [t for (layer, _), t in w.tables.items() if layer == "bronze"] + [w.table("gold", "fact_sales")]
    before = {t.folder: files_of(Path(t.folder)) for t in tables}
    versions = {t.folder: t.version() for t in tables}
    for _ in range(10):
        w.load_bronze(paths)
    w.load_silver()
    w.load_gold(dt.date(2013, 1, 1), dt.date(2013, 1, 31))
    w.vacuum()
    assert {t.folder: files_of(Path(t.folder)) for t in tables} == before
    assert w.table("bronze", "erp_loc_a101").version() == versions[w.table("bronze", "erp_loc_a101").folder] + 10
    assert w.table("gold", "fact_sales").version() == versions[w.table("gold", "fact_sales").folder]


def test_repeated_loads_publish_no_new_dates(house):
    w, paths = house
    before = {n: w.table("gold", n).version() for n in ("dim_date", "dim_customers", "dim_products", "fact_sales")}
    w.load_all(paths, start=dt.date(2013, 1, 1), end=dt.date(2013, 1, 31))
    assert before == {n: w.table("gold", n).version() for n in before}


def test_layer_durations(house):
    w, _ = house
    got = {r.layer: tuple(r)[1:] for r in runlog.layer_durations(w.log.read()).collect()}
    assert got == {"bronze": (6, 0, 0), "silver": (6, 0, 0), "gold": (4, 0, 0)}


def test_whole_error_text_is_logged(spark, tmp_path):
    log = runlog.RunLog(spark, str(tmp_path / "log"), lambda: NOW)

    def fail():
        raise ValueError("x" * 9_000)

    with pytest.raises(ValueError, match="xxx"):
        log.run({"gold.step": fail})
    assert len(log.read().first().error_message) == 9_000


def test_amounts_that_no_int_holds(spark):
    kind = "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt int, sls_ship_dt int, sls_due_dt int, sls_sales int, sls_quantity int, sls_price int"
    raw = spark.createDataFrame([("a", "b", 1, 0, 0, 0, 5, 100_000, 100_000), ("c", "b", 1, 0, 0, 0, None, 2, 10)], kind)
    clean = {r.sls_ord_num: r.sls_sales for r in silver.clean_crm_sales_details(raw).collect()}
    assert clean == {"a": None, "c": 20} and raw.agg(*silver.sales_faults()).first().large_amounts == 1
