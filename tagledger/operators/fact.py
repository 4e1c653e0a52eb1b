"""The price-snapshot fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.operators.heavy import HOT_ROWS, heavy_tables, lookup_join
from tagledger.operators.ordering import global_row_number
from tagledger.operators.trend import previous_value
from tagledger.schemas import FACT_COLUMNS


@dataclass(frozen=True)
class Dims:
    category: DataFrame
    platform: DataFrame
    date: DataFrame
    product: DataFrame | None = None  # not joined: the fact carries its key


def sequence_order() -> list[Column]:
    """Order of ``snapshot_id``; the last two decide ties of the first three."""
    names = ("run_date", "product_key", "scraped_at", "run_hour", "current_price")
    return [F.col(c).asc_nulls_last() for c in names]


def history_order() -> list[Column]:
    """Order of a product's snapshots; the same time can occur in two slots."""
    names = ("scraped_at", "run_date", "run_hour", "current_price")
    return [F.col(c).asc_nulls_last() for c in names]


def star_join(staging: DataFrame, dims: Dims) -> DataFrame:
    """Replace category, platform and date by their keys; no match gives a null key."""
    base = staging.withColumnRenamed("product_id", "product_key")
    joined = lookup_join(base, dims.category, F.col("category") == F.col("category_name"))
    joined = lookup_join(joined, dims.platform, F.col("source") == F.col("platform_name"))
    joined = lookup_join(joined, dims.date, F.col("run_date") == F.col("full_date"))
    return joined.select(*[c for c in FACT_COLUMNS if c not in ("snapshot_id", "previous_price", "price_change")])


def add_trend(
    joined: DataFrame, hot: DataFrame | None = None, spread_copies: bool = True, buckets: int | None = None
) -> DataFrame:
    lagged = previous_value(
        joined,
        "product_key",
        history_order(),
        "current_price",
        "previous_price",
        hot,
        spread_copies=spread_copies,
        buckets=buckets,
    )
    return lagged.withColumn("price_change", F.col("current_price") - F.col("previous_price"))


def heavy_in_staging(staging: DataFrame, hot_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    """Products with very many snapshots, and groups of as many copies of one snapshot."""
    repeated = F.xxhash64("run_date", "product_id", "scraped_at", "run_hour", "current_price")
    return heavy_tables(staging, {"product": F.col("product_id"), "repeated": repeated}, hot_rows)


def build_fact(
    staging: DataFrame,
    dims: Dims,
    hot_rows: int = HOT_ROWS,
    heavy: dict[str, DataFrame] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Star join, sequence number, previous price.

    The number is given first, on the scanned rows: the sampling pass of its
    range shuffle then reads the table again and nothing more.  The shuffle on
    the product comes last and leaves the fact distributed by product, over
    ``buckets`` partitions if that is given.
    """
    heavy = heavy or heavy_in_staging(staging, hot_rows)
    joined = star_join(staging, dims)
    copies = not heavy["repeated"].isEmpty()
    numbered = global_row_number(joined, sequence_order(), "snapshot_id", spread_copies=copies)
    # Rows with a number of their own are not copies of each other any more.
    return add_trend(numbered, heavy["product"], spread_copies=False, buckets=buckets).select(*FACT_COLUMNS)
