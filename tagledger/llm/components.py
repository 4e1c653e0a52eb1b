"""Connected components of a graph given by its edges, in rounds of joins.

Each round makes every node's neighbours point at the smallest of them, first the larger
neighbours, then the smaller ones; the edges shrink to one star per component.  Rounds
grow with the logarithm of the longest path.  Every half round is written to the shared
folder, so that both sides of its join are shuffled by Spark and a hot node can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagledger.session import stage


def _smallest(pairs: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``a``."""
    return stage(pairs.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_m")), "star-least")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b), without the roots themselves.

    The root is the smallest node of the component.  Repeated edges, loops and either
    direction are allowed; edges with a null end are no edges.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    now = edges.filter("a is not null and b is not null and a <> b")
    now = stage(now.select(larger.alias("a"), smaller.alias("b")).distinct(), "star-edges")
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _smallest(both)
        pulled = both.join(least, both.a == F.col("_a")).filter("b > a")
        outer = stage(pulled.select(F.col("b").alias("a"), F.least("_m", "a").alias("b")).distinct(), "star-outer")
        least = _smallest(outer)
        near = outer.join(least, outer.a == F.col("_a"))
        inner = near.filter("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        now = stage(inner.unionByName(least.select(F.col("_a").alias("a"), F.col("_m").alias("b"))).distinct(), "star-edges")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
