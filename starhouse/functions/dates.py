"""Calendar expressions: smart keys, ISO weekdays, English names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """yyyymmdd as an int, by arithmetic so that it stays inside codegen."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(day: Column) -> Column:
    """yyyymm as an int."""
    return F.year(day) * 100 + F.month(day)


def iso_weekday(day: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + 1


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of one calendar day, in DimDate's column order."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (iso_weekday(day) >= 6).alias("is_weekend"),
        month_key(day).alias("month_key"),
    ]
