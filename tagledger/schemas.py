"""Table contracts and the load slot."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import types as T

# Numbers stay text here: inference would type an all-null mrp as string and
# would drop a column that no file of the slot has.
BRONZE_COLUMNS = (
    "product_name",
    "product_url",
    "current_price",
    "mrp",
    "discount_pct",
    "rating",
    "category",
    "source",
    "scraped_at",
)
BRONZE = T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_COLUMNS])

SLOT_PARTITIONS = ("category", "run_date", "run_hour")

SILVER = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("product_url", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("mrp", T.DoubleType()),
        T.StructField("discount_pct", T.IntegerType()),
        T.StructField("has_discount", T.BooleanType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("is_rating_available", T.BooleanType()),
        T.StructField("source", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("run_hour", T.StringType()),
    ]
)
SILVER_COLUMNS = tuple(SILVER.fieldNames())

STAGING_COLUMNS = (
    "product_id",
    "product_name",
    "product_url",
    "brand",
    "category",
    "current_price",
    "mrp",
    "discount_pct",
    "has_discount",
    "rating",
    "is_rating_available",
    "source",
    "scraped_at",
    "run_date",
    "run_hour",
)

FACT_COLUMNS = (
    "snapshot_id",
    "product_key",
    "category_key",
    "platform_key",
    "date_key",
    "current_price",
    "mrp",
    "discount_pct",
    "has_discount",
    "rating",
    "is_rating_available",
    "previous_price",
    "price_change",
    "scraped_at",
    "run_date",
    "run_hour",
)


@dataclass(frozen=True)
class Slot:
    """The unit of loading: a UTC day and a two-digit hour."""

    run_date: date
    run_hour: str

    @classmethod
    def parse(cls, run_date: str, run_hour: str | int) -> "Slot":
        """``Slot.parse('2026-08-04', '06')``; raises ValueError on bad text."""
        day = datetime.strptime(run_date, "%Y-%m-%d").date()
        hour = int(run_hour)
        if not 0 <= hour <= 23:
            raise ValueError(f"run_hour out of range: {run_hour!r}")
        return cls(day, f"{hour:02d}")

    @classmethod
    def current(cls) -> "Slot":
        """The slot of the present UTC hour; read once, on the driver."""
        now = datetime.now(timezone.utc)
        return cls(now.date(), f"{now.hour:02d}")

    @property
    def folder(self) -> str:
        d = self.run_date
        return f"year={d.year}/month={d.month:02d}/day={d.day:02d}/hour={self.run_hour}"
