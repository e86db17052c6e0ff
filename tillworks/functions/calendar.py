"""Date expressions: month keys, calendar attributes, weekend flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_date(day: Column) -> Column:
    return F.trunc(day, "MM")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_id(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_index(day: Column) -> Column:
    """Months counted across years, so that distinct values are distinct calendar months."""
    return F.year(day) * 12 + F.month(day)


def first_of_month(year: Column, month: Column) -> Column:
    padded = F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0")
    return F.to_date(F.concat(*padded, F.lit("01")), "yyyyMMdd")


def is_weekend_flag(day: Column) -> Column:
    """'Y' on Saturday and Sunday (dayofweek counts from 1 = Sunday)."""
    return F.when(F.dayofweek(day).isin(1, 7), "Y").otherwise("N")


def weekend_code(day: Column) -> Column:
    """1 on Saturday and Sunday (weekday counts from 0 = Monday)."""
    return (F.weekday(day) >= 5).cast("int")


def calendar_columns(day: Column) -> list[Column]:
    return [
        date_id(day).alias("date_id"),
        day.alias("full_date"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year_num"),
        is_weekend_flag(day).alias("is_weekend"),
        F.lit("N").alias("is_holiday"),
    ]
