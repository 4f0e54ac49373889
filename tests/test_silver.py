import datetime as dt

from tallyhouse import schemas
from tallyhouse.plans import silver

D = dt.date


def frame(spark, table, *rows):
    return spark.createDataFrame(list(rows), schemas.BRONZE[table])


def test_customers_newest_row_and_codes(spark):
    raw = frame(
        spark,
        "crm_cust_info",
        (1, "A1", " Ann ", "Lee ", " s ", " f", D(2020, 1, 1)),
        (1, "A1", "Ann", "Lee", "m", "M", D(2020, 2, 1)),
        (2, "A2", None, " ", "X", None, None),
        (None, "A3", "ghost", "row", "S", "M", D(2020, 1, 1)),
    )
    rows = silver.clean_crm_cust_info(raw).orderBy("cst_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, "A1", "Ann", "Lee", "Married", "Male", D(2020, 2, 1)),
        (2, "A2", None, "", "n/a", "n/a", None),
    ]


def test_product_versions(spark):
    t = dt.datetime
    raw = frame(
        spark,
        "crm_prd_info",
        (210, "CO-RF-FR-R92B-58", "Frame", None, "R ", t(2003, 7, 1), None),
        (212, "AC-HE-HL-U509-R", "Helmet", 12, "S ", t(2011, 7, 1), t(2007, 12, 28)),
        (213, "AC-HE-HL-U509-R", "Helmet", 14, "s", t(2012, 7, 1), t(2008, 12, 27)),
        # same product key under another category: a line of versions of its own
        (300, "BI-RB-HL-U509-R", "Bike", 99, "q", t(2012, 1, 1), None),
    )
    got = {r.prd_id: tuple(r)[1:] for r in silver.clean_crm_prd_info(raw).collect()}
    assert got == {
        210: ("CO_RF", "FR-R92B-58", "Frame", 0, "Road", D(2003, 7, 1), None),
        212: ("AC_HE", "HL-U509-R", "Helmet", 12, "Other Sales", D(2011, 7, 1), D(2012, 6, 30)),
        213: ("AC_HE", "HL-U509-R", "Helmet", 14, "Other Sales", D(2012, 7, 1), None),
        300: ("BI_RB", "HL-U509-R", "Bike", 99, "n/a", D(2012, 1, 1), None),
    }


def test_sales_repairs(spark):
    cases = {
        # (sales, quantity, price): (sales, price)
        (None, 2, 10): (20, 10),
        (-5, 2, 10): (20, 10),
        (99, 2, 10): (20, 10),
        (20, 2, -10): (20, 10),
        (None, 2, None): (None, None),
        (20, 2, None): (20, 10),
        (None, 2, -10): (20, None),
        (7, 2, 0): (0, 3),
        (20, 0, None): (20, None),
        (20, 2, 10): (20, 10),
        (-7, 2, None): (None, -3),
    }
    rows = [
        (f"SO{i}", "P", 1, 20130703, 0, None, *given) for i, given in enumerate(cases)
    ]
    clean = silver.clean_crm_sales_details(frame(spark, "crm_sales_details", *rows))
    got = {r.sls_ord_num: r for r in clean.collect()}
    for i, want in enumerate(cases.values()):
        row = got[f"SO{i}"]
        assert (row.sls_sales, row.sls_price) == want, list(cases)[i]
        assert (row.sls_order_dt, row.sls_ship_dt, row.sls_due_dt) == (D(2013, 7, 3), None, None)


def test_bad_dates_are_counted(spark):
    rows = [("A", "P", 1, d, 20130101, 5, 1, 1, 1) for d in (20131332, 20130229, 0, 2013, None)]
    counts = silver.bad_sales_dates(frame(spark, "crm_sales_details", *rows))
    assert {r.column_name: r.bad_rows for r in counts.collect()} == {
        "sls_order_dt": 2,
        "sls_ship_dt": 0,
        "sls_due_dt": 0,
    }


def test_erp_tables(spark, tuples):
    people = frame(
        spark,
        "erp_cust_az12",
        ("NASAW1", D(1980, 1, 1), " female"),
        ("AW2", D(2030, 1, 1), ""),
        (None, D(2020, 6, 1), "m"),
    )
    assert tuples(silver.clean_erp_cust_az12(people, D(2020, 6, 1))) == sorted(
        [("AW1", D(1980, 1, 1), "Female"), ("AW2", None, "n/a"), (None, D(2020, 6, 1), "Male")],
        key=repr,
    )
    countries = {"DE": "Germany", " USA": "United States", "US": "United States", " ": "n/a"}
    countries |= {None: "n/a", " France ": "France"}
    places = frame(spark, "erp_loc_a101", *[(f"AW-{i}", c) for i, c in enumerate(countries)])
    assert tuples(silver.clean_erp_loc_a101(places)) == [
        (f"AW{i}", name) for i, name in enumerate(countries.values())
    ]


def test_rows_in_equal_rows_out_and_stamp(spark):
    now = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    raw = frame(spark, "erp_px_cat_g1v2", ("AC_HE", "Accessories", "Helmets", "Yes"))
    out = silver.with_audit(silver.clean_erp_px_cat_g1v2(raw), "erp_px_cat_g1v2", now)
    assert out.columns == schemas.SILVER["erp_px_cat_g1v2"].names
    assert out.count() == 1
