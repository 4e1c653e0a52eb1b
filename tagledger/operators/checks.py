"""Data-quality checks; each counts failures, none stops at the first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagledger.operators.heavy import fits_broadcast

REPORT_COLUMNS = ("test", "table", "column", "failures", "passed")


@dataclass(frozen=True)
class Check:
    """``test`` is unique, not_null, relationship or empty.

    ``parent`` and ``parent_column`` belong to relationship; ``predicate`` is
    SQL text that no row may fulfil, for empty.
    """

    test: str
    table: str
    column: str
    parent: str | None = None
    parent_column: str | None = None
    predicate: str | None = None


STAGING_CHECKS = (
    Check("not_null", "staging", "product_id"),
    Check("not_null", "staging", "current_price"),
    Check("empty", "staging", "mrp", predicate="mrp < 0"),
)
_PRIMARY_KEYS = {
    "dim_date": "date_key",
    "dim_category": "category_key",
    "dim_platform": "platform_key",
    "dim_product": "product_key",
    "fact_price_snapshots": "snapshot_id",
}
_PARENTS = {
    "product_key": "dim_product",
    "category_key": "dim_category",
    "platform_key": "dim_platform",
    "date_key": "dim_date",
}
STAR_CHECKS = (
    *STAGING_CHECKS,
    *[Check("unique", t, c) for t, c in _PRIMARY_KEYS.items()],
    *[Check("not_null", t, c) for t, c in _PRIMARY_KEYS.items()],
    *[Check("not_null", "fact_price_snapshots", c) for c in (*_PARENTS, "current_price")],
    *[Check("relationship", "fact_price_snapshots", c, p, c) for c, p in _PARENTS.items()],
)


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, nulls left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1").agg(F.count(F.lit(1)).alias("failures"))


def check_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Null counts of all ``columns`` in one pass: ``(column, failures)``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.inline(pairs))


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent, null keys left out.

    Child keys are counted before the join, so a hot key is one row in it.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_child"))
    counted = keys.agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias("_parent"))
    orphans = counted.join(known, F.col("_child") == F.col("_parent"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures"))


def check_empty(df: DataFrame, predicate: str) -> DataFrame:
    """Rows that fulfil ``predicate``."""
    return df.filter(predicate).agg(F.count(F.lit(1)).alias("failures"))


def _labelled(failures: DataFrame, test: str, table: str, column: str) -> DataFrame:
    return failures.select(
        F.lit(test).alias("test"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.col("failures").cast("bigint").alias("failures"),
        (F.col("failures") == 0).alias("passed"),
    )


def _known_keys(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The parent's keys, each once, with a marker."""
    keys = tables[check.parent].select(F.col(check.parent_column).alias("_parent")).filter("_parent is not null")
    return keys.distinct().withColumn("_known", F.lit(True))


def _one_pass(df: DataFrame, checks: Sequence[Check], parents: Mapping[Check, DataFrame]) -> DataFrame:
    """Checks that look at a row by itself, or at a parent small enough to broadcast: one scan of ``df``."""
    bad = []
    for n, c in enumerate(checks):
        if c.test == "not_null":
            bad.append(F.col(c.column).isNull())
        elif c.test == "empty":
            bad.append(F.expr(c.predicate))
        else:
            keys = parents[c].withColumnsRenamed({"_parent": f"_parent{n}", "_known": f"_known{n}"})
            df = df.join(F.broadcast(keys), F.col(c.column) == F.col(f"_parent{n}"), "left")
            bad.append(F.col(c.column).isNotNull() & F.col(f"_known{n}").isNull())
    counts = df.agg(*[F.count_if(b).alias(f"n{n}") for n, b in enumerate(bad)])
    rows = [
        F.struct(
            F.lit(c.test).alias("test"),
            F.lit(c.table).alias("table"),
            F.lit(c.column).alias("column"),
            F.col(f"n{n}").cast("bigint").alias("failures"),
            (F.col(f"n{n}") == 0).alias("passed"),
        )
        for n, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row ``(test, table, column, failures, passed)`` per check.

    Per table, one scan serves null counts, predicates and the foreign keys whose parents
    may be broadcast; only unique keys and large parents take a shuffle, and a scan, of their own.
    """
    parts: list[DataFrame] = []
    together: dict[str, list[Check]] = {}
    parents: dict[Check, DataFrame] = {}
    for c in checks:
        df = tables[c.table]
        if c.test in ("not_null", "empty"):
            together.setdefault(c.table, []).append(c)
        elif c.test == "unique":
            parts.append(_labelled(check_unique(df, c.column), c.test, c.table, c.column))
        elif c.test == "relationship":
            keys = _known_keys(c, tables)
            if fits_broadcast(keys):
                parents[c] = keys
                together.setdefault(c.table, []).append(c)
            else:
                found = check_relationship(df, c.column, tables[c.parent], c.parent_column)
                parts.append(_labelled(found, c.test, c.table, c.column))
        else:
            raise ValueError(f"unknown test: {c.test!r}")
    parts += [_one_pass(tables[table], own, parents) for table, own in together.items()]
    return reduce(DataFrame.unionByName, parts)
