"""Number and date series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar the date dimension covers by default.
SPINE_START = date(2026, 1, 1)
SPINE_DAYS = 730


def number_spine(spark: SparkSession, count: int) -> DataFrame:
    """0, 1, … ``count - 1``."""
    return spark.range(count).select(F.col("id").alias("n"))


def date_spine(spark: SparkSession, start: date = SPINE_START, days: int = SPINE_DAYS) -> DataFrame:
    """``days`` consecutive days from ``start``."""
    day = F.date_add(F.lit(start), F.col("n").cast("int"))
    return number_spine(spark, days).select(day.alias("date_day"))
