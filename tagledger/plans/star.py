"""Silver to the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from tagledger.operators.dims import dim_category, dim_date, dim_platform, dim_product
from tagledger.operators.fact import Dims, build_fact, heavy_in_staging
from tagledger.session import stage
from tagledger.sinks.tables import bucket_count, materialize_bucketed, materialize_table, materialize_view, sorted_layout
from tagledger.sources.spine import SPINE_DAYS, SPINE_START


def build_dims(staging: DataFrame, start: date = SPINE_START, days: int = SPINE_DAYS) -> Dims:
    """The small dimensions are numbered from one collapse of staging, not from a scan each."""
    names = stage(staging.select("category", "source").distinct(), "names")
    return Dims(
        category=dim_category(names),
        platform=dim_platform(names),
        date=dim_date(staging.sparkSession, start, days),
        product=dim_product(staging),
    )


def refresh_star(
    staging: DataFrame,
    database: str = "default",
    start: date = SPINE_START,
    days: int = SPINE_DAYS,
    staging_as: str = "view",
) -> dict[str, DataFrame]:
    """Rebuild every model from the whole of staging and return the stored tables.

    Staging is a view unless ``staging_as='table'``: its rows are the silver
    files already, and a copy of them would be written on every refresh.

    Fact and product dimension are stored in the same buckets of the product, as the last shuffle of the
    fact leaves its rows: joins of the two and windows per product read them without a shuffle.  If a
    product is too hot for one task, both are stored without buckets.
    """
    if staging_as == "table":
        base = materialize_table(staging, f"{database}.staging_prices")
    elif staging_as == "view":
        base = materialize_view(staging, "staging_prices")
    else:
        raise ValueError(f"unknown staging_as: {staging_as!r}")
    dims = build_dims(base, start, days)
    heavy = heavy_in_staging(base)
    buckets = bucket_count(base) if heavy["product"].isEmpty() else None
    products = f"{database}.dim_product"
    stored = Dims(
        category=materialize_table(sorted_layout(dims.category, ["category_key"]), f"{database}.dim_category"),
        platform=materialize_table(sorted_layout(dims.platform, ["platform_key"]), f"{database}.dim_platform"),
        date=materialize_table(sorted_layout(dims.date, ["date_key"]), f"{database}.dim_date"),
        product=materialize_bucketed(dims.product, products, "product_key", buckets, ["product_key"])
        if buckets
        else materialize_table(sorted_layout(dims.product, ["product_key"]), products),
    )
    sort = ["run_date", "product_key", "scraped_at"]
    fact = build_fact(base, stored, heavy=heavy, buckets=buckets)
    facts = f"{database}.fact_price_snapshots"
    return {
        "staging": base,
        "dim_category": stored.category,
        "dim_platform": stored.platform,
        "dim_date": stored.date,
        "dim_product": stored.product,
        "fact_price_snapshots": materialize_bucketed(fact, facts, "product_key", buckets, sort, placed=True)
        if buckets
        else materialize_table(fact.sortWithinPartitions(*sort), facts),
    }
