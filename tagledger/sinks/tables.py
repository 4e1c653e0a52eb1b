"""Models as tables and views, and their physical layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagledger.session import IN_MEMORY_GROWTH, PARTITION_BYTES, table_bytes


def materialize_table(df: DataFrame, name: str) -> DataFrame:
    """Full refresh: the result replaces the table."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def sorted_layout(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Global order in files that can be skipped by the range of the leading column."""
    order = [F.col(c).asc_nulls_last() for c in by]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def keyed_layout(df: DataFrame, key: str, sort: Sequence[str]) -> DataFrame:
    """Rows of one key together, sorted inside each file.

    A rebalance, not a hash repartition: the partition of a hot key is cut up.
    """
    return df.hint("rebalance", key).sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in sort])


def bucket_count(df: DataFrame, least: int | None = None) -> int:
    """Buckets for a table made of the files of ``df``: a power of two, so that tables of all sizes fit each other."""
    wanted = table_bytes(df) * IN_MEMORY_GROWTH // PARTITION_BYTES
    least = least or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(0, max(wanted, least) - 1).bit_length()


def materialize_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, sort: Sequence[str], placed: bool = False
) -> DataFrame:
    """Full refresh into buckets of ``key``, so joins and windows on it need no shuffle.

    ``placed``: the rows are already distributed by ``key`` over as many partitions, and stay where they are.
    A bucket is read by one task; for a table with a hot key ``keyed_layout`` is the layout to choose.
    """
    rows = df if placed else df.repartition(buckets, key)
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(*sort).saveAsTable(name)
    return df.sparkSession.table(name)
