"""Date expressions: boundary-counting differences, US weeks, yyyymmdd integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_diff(start: Column, end: Column) -> Column:
    """Month boundaries crossed: 31 January to 1 February is 1."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def year_diff(start: Column, end: Column) -> Column:
    """Year boundaries crossed: 31 December to 1 January is 1."""
    return F.year(end) - F.year(start)


def us_week(day: Column) -> Column:
    """Week of year where 1 January is in week 1 and weeks start on Sunday."""
    leading = F.dayofweek(F.trunc(day, "YEAR")) - 1
    return F.floor((F.dayofyear(day) - 1 + leading) / 7).cast("int") + 1


def yyyymmdd(number: Column) -> Column:
    """Date of an integer such as 20130703; NULL for anything that is not a day.

    The ISO form is cast, which is cheaper than parsing by a pattern.
    """
    digits = number.cast("string")
    day = F.concat_ws(
        "-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)
    )
    return F.when(number.between(10_000_000, 99_999_999), day.try_cast("date"))


def eight_digits(number: Column) -> Column:
    """True for the numbers a yyyymmdd feed means as a day, real or not."""
    return F.length(number.cast("string")) == 8


def calendar_columns(day: Column) -> list[Column]:
    """The calendar attributes of a day: English names, Sunday is day 1."""
    weekday = F.dayofweek(day)
    return [
        day.alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        us_week(day).alias("week_number"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    ]
