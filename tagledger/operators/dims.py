"""Dimension tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagledger.functions.calendar import calendar_columns
from tagledger.operators.dedupe import keep_latest
from tagledger.operators.ordering import global_row_number
from tagledger.sources.spine import SPINE_DAYS, SPINE_START, date_spine


def _named_keys(staging: DataFrame, column: str, name: str, key: str) -> DataFrame:
    """Distinct values numbered in order, null last; any number of values."""
    names = staging.select(F.col(column).alias(name)).distinct()
    return global_row_number(names, [F.col(name).asc_nulls_last()], key, spread_copies=False)


def dim_category(staging: DataFrame) -> DataFrame:
    return _named_keys(staging, "category", "category_name", "category_key")


def dim_platform(staging: DataFrame) -> DataFrame:
    keyed = _named_keys(staging, "source", "platform_name", "platform_key")
    return keyed.withColumn("platform_url", F.col("platform_name"))


def dim_product(staging: DataFrame) -> DataFrame:
    """One row per product with its newest attributes."""
    latest = keep_latest(
        staging,
        "product_id",
        when="scraped_at",
        ties=["run_date", "run_hour"],
        columns=["product_name", "brand", "category", "product_url"],
    )
    return latest.withColumnRenamed("product_id", "product_key")


def dim_date(spark: SparkSession, start: date = SPINE_START, days: int = SPINE_DAYS) -> DataFrame:
    return date_spine(spark, start, days).select(*calendar_columns(F.col("date_day")))
