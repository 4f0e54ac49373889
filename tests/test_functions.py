import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import dates, values
from tallyhouse.plans.analytics import cost_band, customer_segment
from tallyhouse.plans.gold import build_dim_date
from tallyhouse.plans.reports import age_group, product_tier

D = dt.date


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "a, b, months, years",
    [
        (D(2020, 1, 31), D(2020, 2, 1), 1, 0),
        (D(2020, 1, 1), D(2020, 1, 31), 0, 0),
        (D(2019, 12, 31), D(2020, 1, 1), 1, 1),
        (D(2020, 3, 1), D(2020, 1, 31), -2, 0),
    ],
)
def test_differences_count_boundaries(spark, a, b, months, years):
    assert one(spark, dates.month_diff(F.lit(a), F.lit(b))) == months
    assert one(spark, dates.year_diff(F.lit(a), F.lit(b))) == years


@pytest.mark.parametrize(
    "day, week",
    [(D(2000, 12, 31), 54), (D(2023, 1, 1), 1), (D(2023, 1, 7), 1), (D(2023, 1, 8), 2)],
)
def test_us_week(spark, day, week):
    assert one(spark, dates.us_week(F.lit(day))) == week


@pytest.mark.parametrize(
    "number, day",
    [
        (20130703, D(2013, 7, 3)),
        (0, None),
        (2013, None),
        (None, None),
        (20131332, None),
        (20130229, None),
        (-2013070, None),
        (201307031, None),
    ],
)
def test_yyyymmdd(spark, number, day):
    assert one(spark, dates.yyyymmdd(F.lit(number).cast("int"))) == day


@pytest.mark.parametrize(
    "code, label", [(" s ", "Single"), ("m", "Married"), ("X", "n/a"), (None, "n/a"), ("", "n/a")]
)
def test_map_codes(spark, code, label):
    text = F.lit(code).cast("string")
    assert one(spark, values.map_codes(text, {"S": "Single", "M": "Married"})) == label


def test_names_and_blanks(spark):
    null = F.lit(None).cast("string")
    assert one(spark, values.full_name(F.lit("Ann"), null)) == "Ann "
    assert one(spark, values.full_name(null, null)) == " "
    assert one(spark, values.blank_to_null(F.lit("  "))) is None
    assert one(spark, values.unknown_to_null(F.lit("n/a"))) is None


@pytest.mark.parametrize("a, b, q", [(7, 2, 3), (-7, 2, -3), (20, 0, None), (None, 2, None)])
def test_int_div(spark, a, b, q):
    row = spark.createDataFrame([(a, b)], "a int, b int")
    assert row.select(values.int_div("a", "b")).first()[0] == q


@pytest.mark.parametrize(
    "cost, band",
    [
        (99, "Below 100"),
        (100, "100-500"),
        (500, "100-500"),
        (501, "500-1000"),
        (1000, "500-1000"),
        (1001, "Above 1000"),
        (None, "Above 1000"),
    ],
)
def test_cost_bands(spark, cost, band):
    assert one(spark, cost_band(F.lit(cost).cast("decimal(18,2)"))) == band


@pytest.mark.parametrize(
    "months, sales, segment",
    [
        (12, 5001, "VIP"),
        (12, 5000, "Regular"),
        (11, 9999, "New"),
        (None, 9999, "New"),
        (12, None, "New"),
    ],
)
def test_segments(spark, months, sales, segment):
    lifespan, spent = F.lit(months).cast("int"), F.lit(sales).cast("int")
    assert one(spark, customer_segment(lifespan, spent)) == segment


@pytest.mark.parametrize(
    "age, group",
    [(19, "Under 20"), (20, "20-29"), (49, "40-49"), (50, "50 and above"), (None, "50 and above")],
)
def test_age_groups(spark, age, group):
    assert one(spark, age_group(F.lit(age).cast("int"))) == group


@pytest.mark.parametrize(
    "sales, tier",
    [(50001, "High-Performer"), (50000, "Mid-Range"), (10000, "Mid-Range"), (9999, "Low-Performer")],
)
def test_product_tiers(spark, sales, tier):
    assert one(spark, product_tier(F.lit(sales))) == tier


def test_default_calendar(spark):
    calendar = build_dim_date(spark)
    assert calendar.count() == 11323
    day = calendar.filter(F.col("date_key") == D(2000, 12, 31)).first().asDict()
    assert day == {
        "date_key": D(2000, 12, 31),
        "year": 2000,
        "quarter": 4,
        "month_number": 12,
        "month_name": "December",
        "week_number": 54,
        "day_of_week": 1,
        "day_name": "Sunday",
        "is_weekend": True,
        "is_holiday": False,
    }
