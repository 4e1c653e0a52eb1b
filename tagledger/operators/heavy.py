"""Finding keys that hold too many rows for one task, and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.session import stage

# Largest table sent to every executor, in rows and in bytes of their text form.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20

# A key above this many rows is spread over several tasks.
HOT_ROWS = 10_000_000

# Rows are counted by this many hash ranges of their keys first.
RANGES = 1 << 16


def heavy_tables(
    df: DataFrame, exprs: dict[str, Column], min_rows: int = HOT_ROWS, ranges: int = RANGES
) -> dict[str, DataFrame]:
    """For each expression a stored table of its values that have at least ``min_rows`` rows: (value, n).

    Exact at any size, in two passes over the columns the expressions read.  Rows are counted by hash range of
    the value, at most ``ranges`` sums per task; a value cannot have more rows than its range.  Values
    themselves are counted only in the ranges that reach ``min_rows``, with partial sums, so
    a value with much of the table is one row per task.  A table holds at most (rows / ``min_rows``) values.
    """
    narrow = df.select(*[e.alias(n) for n, e in exprs.items()])
    at = {n: F.pmod(F.xxhash64(F.col(f"`{n}`")), F.lit(ranges)).cast("int") for n in exprs}
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), at[n].alias("range")) for n in exprs])
    counted = narrow.select(F.inline(pairs)).groupBy("name", "range").agg(F.count("*").alias("n"))
    full = counted.filter(F.col("n") >= min_rows).groupBy("name").agg(F.collect_list("range").alias("found"))
    # At most ``ranges`` small numbers per expression.
    found = {r["name"]: r["found"] for r in full.collect()}
    out = {}
    for n in exprs:
        values = narrow.select(F.col(f"`{n}`").alias("value"), at[n].alias("_range")).filter("value is not null")
        marks = df.sparkSession.createDataFrame([(r,) for r in found.get(n, [])], "_mark int")
        if n in found:
            inside = values.join(F.broadcast(marks), F.col("_range") == F.col("_mark"), "left_semi")
        else:
            inside = values.filter(F.lit(False))
        sums = inside.groupBy("value").agg(F.count("*").alias("n"))
        out[n] = stage(sums.filter(F.col("n") >= min_rows), "heavy") if n in found else sums
    return out


def heavy_values(df: DataFrame, exprs: dict[str, Column], min_rows: int = HOT_ROWS) -> dict[str, list]:
    """The values of ``heavy_tables`` as lists, for tables that are known to be small."""
    return {n: [r["value"] for r in t.collect()] for n, t in heavy_tables(df, exprs, min_rows).items()}


def heavy_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> list:
    return heavy_values(df, {key: F.col(key)}, min_rows)[key]


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure at most ``max_rows + 1`` rows to learn if ``df`` is small in rows and in bytes."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])))
    size = df.limit(max_rows + 1).agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def lookup_join(
    df: DataFrame,
    small: DataFrame,
    on: Column,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join to a lookup table: broadcast it if its checked size allows.

    Beyond ``max_rows`` or ``max_bytes`` the planner joins by shuffle; adaptive execution splits
    the partitions of hot keys there.
    """
    if fits_broadcast(small, max_rows, max_bytes):
        small = F.broadcast(small)
    return df.join(small, on, how)
