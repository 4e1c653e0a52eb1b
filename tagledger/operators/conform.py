"""Bronze text to typed, valid, enriched rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.functions.identity import product_id
from tagledger.functions.text import first_word, trim_spaces


def cast_types(bronze: DataFrame) -> DataFrame:
    """Text that is no number or no timestamp becomes null, never an error."""
    return bronze.withColumns(
        {
            "current_price": F.col("current_price").try_cast("double"),
            "mrp": F.col("mrp").try_cast("double"),
            # Through double: '7.5' is 7 here, where a cast to int would fail.
            "discount_pct": F.col("discount_pct").try_cast("double").try_cast("int"),
            "rating": F.col("rating").try_cast("double"),
            "scraped_at": F.try_to_timestamp(F.col("scraped_at")),
            "product_name": trim_spaces(F.col("product_name")),
        }
    )


def is_valid() -> Column:
    """A name and a positive price.  Never null; an empty name and a NaN price pass."""
    priced = F.coalesce(F.col("current_price") > 0, F.lit(False))
    return F.col("product_name").isNotNull() & priced


def valid_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(is_valid())


def fill_and_key(typed: DataFrame) -> DataFrame:
    """Product key, and values for a missing discount and list price."""
    return typed.withColumns(
        {
            "product_id": product_id(F.col("product_name"), F.col("category")),
            "discount_pct": F.coalesce(F.col("discount_pct"), F.lit(0)),
            "mrp": F.coalesce(F.col("mrp"), F.col("current_price")),
        }
    )


def derive(filled: DataFrame) -> DataFrame:
    """Columns that follow from one other column each.

    A missing discount counts as none whether it is null or already 0.
    """
    return filled.withColumns(
        {
            "brand": first_word(F.col("product_name")),
            "has_discount": F.coalesce(F.col("discount_pct") > 0, F.lit(False)),
            "is_rating_available": F.coalesce(F.col("rating") > 0, F.lit(False)),
            "run_date": F.to_date("scraped_at"),
        }
    )


def enrich(typed: DataFrame) -> DataFrame:
    return derive(fill_and_key(typed))
