"""Bronze rows of one slot to silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagledger.operators.conform import cast_types, derive, fill_and_key, is_valid, valid_rows
from tagledger.operators.dedupe import keep_one
from tagledger.schemas import SILVER_COLUMNS, Slot

VALID = "_valid"
COPIES = "_copies"

KEYS = ("product_id", "scraped_at")
# The columns that are not derived from others; only these are sorted and shuffled.
CARRIED = ("product_name", "product_url", "category", "current_price", "mrp", "discount_pct", "rating", "source")


def build_silver(bronze: DataFrame, slot: Slot) -> DataFrame:
    """Type, filter, enrich and deduplicate; one row per product and scrape time."""
    keyed = fill_and_key(valid_rows(cast_types(bronze))).select(*KEYS, *CARRIED)
    kept = derive(keep_one(keyed, KEYS))
    return kept.withColumn("run_hour", F.lit(slot.run_hour)).select(*SILVER_COLUMNS)


def counted_silver(bronze: DataFrame, slot: Slot) -> DataFrame:
    """Silver rows with the number of bronze rows behind each, plus one row for all invalid ones.

    The counts are part of the rows: added up from a stored copy, they are the same after a lost
    executor, and for slots where no row is valid.
    """
    flagged = fill_and_key(cast_types(bronze)).withColumn(VALID, is_valid())
    blank = [F.when(F.col(VALID), F.col(c)).alias(c) for c in (*KEYS, *CARRIED)]
    merged = keep_one(flagged.select(VALID, *blank), (VALID, *KEYS), COPIES)
    derived = derive(merged).withColumn("run_hour", F.lit(slot.run_hour))
    return derived.select(VALID, COPIES, *SILVER_COLUMNS)


def metric_columns() -> list:
    valid, copies = F.col(VALID), F.col(COPIES)
    return [
        F.coalesce(F.sum(copies), F.lit(0)).cast("bigint").alias("raw_rows"),
        F.coalesce(F.sum(F.when(valid, copies)), F.lit(0)).cast("bigint").alias("valid_rows"),
        F.coalesce(F.sum(F.when(~valid, copies)), F.lit(0)).cast("bigint").alias("invalid_rows"),
        F.count_if(valid).cast("bigint").alias("deduped_rows"),
    ]


def silver_metrics(bronze: DataFrame, slot: Slot) -> DataFrame:
    """One row of counts, in one pass over the bronze rows."""
    return counted_silver(bronze, slot).agg(*metric_columns())


def loadable(counted: DataFrame) -> DataFrame:
    """The silver rows among counted ones."""
    return counted.filter(VALID).select(*SILVER_COLUMNS)
