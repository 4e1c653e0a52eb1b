"""Calendar parts of a date, in the forms a date dimension carries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_WIDTH = 9  # fixed value: day and month names are blank-padded to this width


def date_key(day: Column) -> Column:
    """20260104 for 2026-01-04."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), NAME_WIDTH, " ")


def month_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "MMMM"), NAME_WIDTH, " ")


def day_of_week(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(day) - 1).cast("int")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def calendar_columns(day: Column) -> list[Column]:
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.dayofmonth(day).alias("day_of_month"),
        day_name(day).alias("day_name"),
        day_of_week(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_number"),
        F.month(day).alias("month"),
        month_name(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        is_weekend(day).alias("is_weekend"),
    ]
