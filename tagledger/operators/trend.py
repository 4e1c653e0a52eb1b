"""Value of the previous snapshot, also for products with very many snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagledger.operators.heavy import HOT_ROWS, heavy_tables, lookup_join
from tagledger.operators.ordering import POSITION, RUN, sorted_runs


def previous_value(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    value: str,
    name: str,
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    spread_copies: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """``lag(value) over (partition by key order by …)``.

    Rows of ordinary keys take one shuffle on the key, into ``buckets`` partitions if that is given.  Keys
    with ``hot_rows`` rows or more are sorted over many tasks instead; a caller that has
    already counted them passes them as ``hot``, a table with a column ``value``.
    """
    if hot is None:
        hot = heavy_tables(df, {key: F.col(key)}, hot_rows)[key]
    if hot.isEmpty():
        return _by_window(df, key, order, value, name, buckets)
    hot = hot.select(F.col("value").alias("_hot"))
    same = F.col(key) == F.col("_hot")
    cool = _by_window(lookup_join(df, hot, same, "left_anti"), key, order, value, name, buckets)
    return cool.unionByName(_by_runs(lookup_join(df, hot, same, "left_semi"), key, order, value, name, spread_copies))


def _by_window(
    df: DataFrame, key: str, order: Sequence[Column], value: str, name: str, buckets: int | None = None
) -> DataFrame:
    placed = df.repartition(buckets, key) if buckets else df
    return placed.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(*order)))


def _by_runs(
    df: DataFrame, key: str, order: Sequence[Column], value: str, name: str, spread_copies: bool
) -> DataFrame:
    """Lag inside each sorted run; the first row of a run takes the last one before it."""
    runs = sorted_runs(df, [F.col(key).asc_nulls_last(), *order], "hot", spread_copies)
    # A sorted table has at most (number of runs + number of hot keys) of these.
    lasts = runs.groupBy(RUN, key).agg(F.max_by(value, POSITION).alias("_last"))
    carried = F.lag("_last").over(Window.partitionBy(key).orderBy(RUN))
    carry = lasts.select(F.col(RUN).alias("_r"), F.col(key).alias("_k"), carried.alias("_carried"))
    inside = Window.partitionBy(RUN, key).orderBy(POSITION)
    lagged = runs.withColumn("_first", F.row_number().over(inside) == 1).withColumn(
        "_inside", F.lag(value).over(inside)
    )
    joined = lagged.join(F.broadcast(carry), (F.col(RUN) == F.col("_r")) & (F.col(key) == F.col("_k")), "left")
    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_inside"))
    return joined.select(*df.columns, previous.alias(name))
