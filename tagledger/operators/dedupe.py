"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], copies: str | None = None) -> DataFrame:
    """Per key the row with the smallest remaining columns, in column order, nulls first.

    An aggregate, not a window: copies are merged before the shuffle, so a key
    that holds much of the table sends one row per task.  The hash in front of the
    keys makes their sort cheap: it seldom has to look at the keys themselves.
    ``copies`` names a column for the number of rows merged.
    """
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.min(F.struct(*rest)).alias("_row")]
    if copies:
        aggs.append(F.count(F.lit(1)).alias(copies))
    merged = df.withColumn("_hash", F.xxhash64(*keys)).groupBy("_hash", *keys).agg(*aggs)
    columns = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return merged.select(*columns, *([copies] if copies else []))


def keep_latest(df: DataFrame, key: str, when: str, ties: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key the ``columns`` of the row with the greatest ``when``; a null one counts as greatest.

    Equal times are decided by ``ties`` and then by the columns, the greatest first.
    """
    by = [F.col(when).isNull().alias("_undated"), F.col(when)]
    row = F.max(F.struct(*by, *ties, *[c for c in columns if c not in (when, *ties)])).alias("_row")
    return df.groupBy(key).agg(row).select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])
