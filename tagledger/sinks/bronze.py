"""Writing raw records into their slot folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagledger.schemas import BRONZE_COLUMNS, Slot


def write_bronze(df: DataFrame, root: str, slot: Slot | None = None) -> Slot:
    """Append ``df`` under ``source=/category=/year=/month=/day=/hour=``, one object per line.

    The body keeps ``source`` and ``category``: it is rendered before the
    partition columns are split off.  Without a slot the current UTC hour is used.
    """
    slot = slot or Slot.current()
    day = slot.run_date
    body = F.to_json(F.struct(*BRONZE_COLUMNS), {"ignoreNullFields": "false"})
    folders = {
        "source": F.col("source"),
        "category": F.col("category"),
        "year": F.lit(str(day.year)),
        "month": F.lit(f"{day.month:02d}"),
        "day": F.lit(f"{day.day:02d}"),
        "hour": F.lit(slot.run_hour),
    }
    lines = df.select(body.alias("value"), *[c.alias(n) for n, c in folders.items()])
    lines.hint("rebalance", "source", "category").write.mode("append").partitionBy(*folders).text(root)
    return slot
