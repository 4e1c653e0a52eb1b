"""Sequences over a whole table without a task that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagledger.operators.heavy import lookup_join
from tagledger.session import stage

# monotonically_increasing_id() keeps the partition above this bit and the
# position inside the partition below it.
_POSITION_BITS = 33

RUN = "_run"
POSITION = "_position"


def sorted_runs(
    df: DataFrame,
    order: Sequence[Column],
    label: str = "runs",
    spread_copies: bool = True,
) -> DataFrame:
    """Sort ``df`` over all partitions and write it as numbered runs.

    Adds ``_run`` (runs are in sort order) and ``_position`` (0, 1, 2 … inside
    the run).  The range shuffle samples the full sort key, ties ordered by a
    hash of the whole row, so a hot leading key is cut into many runs.

    ``spread_copies`` also cuts groups of rows that are equal in every column, by
    their place in a sorted input partition; the sort makes a repeated task give
    the same places.  Leave it out where the rows are known to differ.
    """
    columns = [F.col(f"`{n}`") for n in df.columns]
    placed = df.withColumn("_tie", F.xxhash64(*columns))
    by = [*order, F.col("_tie").asc()]
    if spread_copies:
        # Two hashes, 96 bits: rows that tie here are copies.
        placed = placed.withColumn("_tie2", F.hash(*columns)).sortWithinPartitions(*by, "_tie2")
        placed = placed.withColumn("_copy", F.monotonically_increasing_id())
        by = [*by, F.col("_copy").asc()]
    ranged = placed.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = ranged.withColumn("_at", F.monotonically_increasing_id()).select(
        *columns,
        F.shiftright("_at", _POSITION_BITS).cast("int").alias(RUN),
        F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias(POSITION),
    )
    return stage(numbered, label)


def run_offsets(runs: DataFrame) -> DataFrame:
    """Rows before each run: one row per run, so as many as there were partitions."""
    sizes = runs.groupBy(RUN).agg((F.max(POSITION) + 1).alias("n"))
    before = Window.orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(RUN, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))


def global_row_number(
    df: DataFrame, order: Sequence[Column], name: str, spread_copies: bool = True
) -> DataFrame:
    """``row_number() over (order by …)`` as a bigint column, dense from 1.

    The only single-task step is over the run sizes, one row per run.
    """
    runs = sorted_runs(df, order, name, spread_copies)
    placed = runs.join(F.broadcast(run_offsets(runs)), RUN)
    number = (F.col("_before") + F.col(POSITION) + 1).cast("bigint")
    return placed.select(number.alias(name), *df.columns)


def grouped_row_number(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """``row_number() over (partition by group order by …)`` for groups of any size."""
    whole = global_row_number(df, [F.col(group).asc_nulls_last(), *order], "_whole")
    firsts = whole.groupBy(F.col(group).alias("_group")).agg(F.min("_whole").alias("_first"))
    joined = lookup_join(whole, firsts, F.col(group).eqNullSafe(F.col("_group")))
    number = (F.col("_whole") - F.col("_first") + 1).cast("bigint")
    return joined.select(number.alias(name), *df.columns)
