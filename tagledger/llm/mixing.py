"""Mixing sources to target weights by weighted fair queueing.

Documents of a source are shuffled by a digest of their id and text.  A copy of a
document finishes at the virtual time (tokens of its source up to and with it) divided
by the source's target; a source that is wanted more than once is queued again behind
itself.  Copies are taken in order of virtual time until the total budget is used up.

How it scales: running totals are kept in two levels.  Digests spread the documents of
every source, also of a hot one, over buckets of bounded size; one running total goes over
the buckets of a source, one over the rows of a bucket.  The cut is found the same way
over slices of virtual time; only the slice that holds the cut is ordered row by row.
Texts are not shuffled: the cut of a source is a single point of its order, so documents
are compared with it where they lie.

Sizes are words between ASCII white space.  Null text has size 0 and takes nothing.  A null
source is a source of its own, after all others.  Rows equal in source, id and text are
one unit: all of them are taken, or none.  Empty input gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagledger.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
BUCKET_ROWS = 8_000  # rows that one running total goes over


def words(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in the text."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    blanks = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit("")))
    return F.when(plain == "", 0).otherwise(blanks + 1).cast("bigint")


def place(id_: Column, text: Column) -> Column:
    """A document's place in the shuffled order."""
    digest = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit("|"), digest))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT
) -> DataFrame:
    """Tokens wanted of each source, from (source, source_size): one row per source.

    Weights repeat over the sources in order of code points.  A source stops at ``limit``
    times its size, and what it leaves is shared anew by weight.  Sorted by the share at
    which they stop, the stopped sources come first: the level of the others is what is left
    for their weights, and the last source that stops is the last above its own level.
    The two windows go over one row per source.
    """
    nth = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("_full", "_nth")
    number = F.row_number().over(nth) - 1
    ranked = sizes.withColumn("_nth", number).withColumn(
        "_weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_nth") % len(weights) + 1).cast("int"))
    )
    whole = Window.partitionBy()
    ahead = fill.rowsBetween(Window.unboundedPreceding, -1)
    behind = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.col("source_size") * limit
    levelled = ranked.withColumns({"_cap": cap, "_full": cap / F.col("_weight")}).withColumns(
        {
            "_budget": F.sum("source_size").over(whole) * F.lit(float(share)),
            "_used": F.coalesce(F.sum("_cap").over(ahead), F.lit(0)),
            "_weights": F.sum("_weight").over(behind),
        }
    )
    # A source stops if its share of what is left reaches its cap.
    stops = (F.col("_budget") - F.col("_used")) * F.col("_weight") >= F.col("_cap") * F.col("_weights")
    flagged = levelled.withColumn("_stops", stops)
    left = F.max(F.when(~F.col("_stops"), F.col("_budget") - F.col("_used"))).over(whole)
    weight = F.max(F.when(~F.col("_stops"), F.col("_weights"))).over(whole)
    shared = flagged.withColumns({"_left": left, "_rest": weight})
    target = F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(
        F.col("_weight") * F.col("_left") / F.col("_rest")
    )
    return shared.select("source", "source_size", target.alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def queue(units: DataFrame, targets: DataFrame, rows: int, limit: int = LIMIT) -> DataFrame:
    """Units (source, place, size, copies) with ``total`` (tokens of the source up to and with the unit)."""
    digits = max(1, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS + 1, 16)))
    cut = units.withColumn("_bucket", F.substring("place", 1, digits))
    sums = cut.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"),
        F.col("_bucket").alias("_own"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy("source", "_bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = cut.withColumn("_inside", F.sum("size").over(inside))
    placed = running.join(starts, _same(F.col("source"), F.col("_source")) & (F.col("_bucket") == F.col("_own")))
    placed = placed.withColumn("total", F.col("_start") + F.col("_inside"))
    wanted = targets.withColumnRenamed("source", "_of")
    return placed.join(wanted, _same(F.col("source"), F.col("_of"))).select(
        "source", "place", "size", "total", "source_size", "target"
    )


def cut_points(queued: DataFrame, budget: float, rows: int, limit: int = LIMIT) -> DataFrame:
    """For each source and round, the last place that is taken.

    Every round of a source's queue is a row per unit; slices of virtual time are summed
    first, then the slice in which the budget runs out is ordered row by row.
    """
    rounds = F.explode(F.sequence(F.lit(0), F.lit(limit - 1))).alias("round")
    turns = queued.filter("size > 0").select("*", rounds)
    time = (F.col("round") * F.col("source_size") + F.col("total")) / F.col("target")
    slices = max(16, rows // BUCKET_ROWS)
    timed = turns.withColumn("time", time).withColumn(
        "slice", F.floor(F.col("time") * slices).cast("bigint")
    )
    timed = stage(timed.select("source", "round", "place", "size", "time", "slice"), "mix-queue")
    sums = timed.groupBy("slice").agg(F.sum("size").alias("_sum"))
    upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    running = sums.withColumn("_upto", F.sum("_sum").over(upto))
    # One row: the first slice that does not fit as a whole.
    over = running.filter(F.col("_upto") > F.lit(budget)).orderBy("slice").limit(1).collect()
    if over:
        edge, room = over[0]["slice"], budget - (over[0]["_upto"] - over[0]["_sum"])
        order = Window.partitionBy("slice").orderBy("time", F.col("source").asc_nulls_last(), "place")
        inside = order.rowsBetween(Window.unboundedPreceding, 0)
        last = timed.filter(F.col("slice") == edge).withColumn("_upto", F.sum("size").over(inside))
        taken = timed.filter(F.col("slice") < edge).unionByName(
            last.filter(F.col("_upto") <= F.lit(room)).drop("_upto")
        )
    else:
        taken = timed
    return taken.groupBy("source", "round").agg(F.max("place").alias("last"))


def mix(
    docs: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
) -> DataFrame:
    """Every document with size, source_size, target, copies (how often it is taken) and taken (words).

    Columns of these names are replaced; all others stay as they are.
    """
    keep = [c for c in docs.columns if c not in {"size", "source_size", "target", "copies", "taken"}]
    named = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(f"`{source}`").alias("_source"),
        place(F.col(f"`{id_}`"), F.col(f"`{text}`")).alias("_place"),
        words(F.col(f"`{text}`")).alias("size"),
    )
    narrow = named.select(F.col("_source").alias("source"), F.col("_place").alias("place"), "size")
    units = stage(narrow.groupBy("source", "place").agg(F.sum("size").alias("size")), "mix-units")
    totals = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    totals = stage(totals, "mix-sources")
    sums = totals.agg(F.sum("source_size").alias("size"), F.sum("_rows").alias("rows")).first()
    budget, rows = (sums["size"] or 0) * float(share), sums["rows"] or 0
    targets = stage(source_targets(totals.drop("_rows"), weights, share, limit), "mix-targets")
    last = cut_points(queue(units, targets, rows, limit), budget, rows, limit)
    ends = last.groupBy("source").pivot("round", list(range(limit))).agg(F.first("last"))
    ends = ends.select(F.col("source").alias("_ended"), *[F.col(str(r)).alias(f"_last{r}") for r in range(limit)])
    points = targets.join(ends, _same(F.col("source"), F.col("_ended")), "left").drop("_ended")
    points = stage(points.withColumnRenamed("source", "_of"), "mix-points")
    copies = sum((F.coalesce(F.col("_place") <= F.col(f"_last{r}"), F.lit(False)).cast("int") for r in range(limit)), F.lit(0))
    joined = named.join(points, _same(F.col("_source"), F.col("_of")))
    counted = joined.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0))
    return counted.select(
        *[F.col(f"`{c}`") for c in keep],
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus itself: every document as often as it is taken, with its own columns."""
    taken = mix(docs, **how)
    return taken.filter("copies > 0").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    ).drop("_copy")


def mixing_report(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def mixing_sql() -> str:
    """The same in DuckDB's SQL, with plain windows."""
    weights = f"[{', '.join(map(str, WEIGHTS))}]"
    return rf"""
    WITH named AS (
      SELECT doc_id, source, md5(coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))) AS place,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS size
      FROM documents),
    units AS (SELECT source, place, sum(size)::bigint AS size FROM named GROUP BY ALL),
    totals AS (SELECT source, sum(size)::bigint AS source_size FROM units GROUP BY source),
    ranked AS (
      SELECT *, {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::int] AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS nth, source_size * {LIMIT} AS cap,
             sum(source_size) OVER () * {SHARE}::double AS budget
      FROM totals),
    levelled AS (
      SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
             sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
      FROM ranked),
    flagged AS (SELECT *, (budget - used) * weight >= cap * weights AS stops FROM levelled),
    targets AS (
      SELECT source, source_size,
             CASE WHEN stops THEN cap::double
                  ELSE weight * max(CASE WHEN NOT stops THEN budget - used END) OVER ()
                       / max(CASE WHEN NOT stops THEN weights END) OVER () END AS target, budget
      FROM flagged),
    queued AS (
      SELECT u.*, t.source_size, t.target, t.budget,
             sum(u.size) OVER (PARTITION BY u.source ORDER BY place ROWS UNBOUNDED PRECEDING) AS total
      FROM units u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source),
    turns AS (
      SELECT *, (round * source_size + total) / target AS time
      FROM queued, range({LIMIT}) AS r(round) WHERE size > 0),
    spent AS (
      SELECT *, sum(size) OVER (ORDER BY time, source NULLS LAST, place ROWS UNBOUNDED PRECEDING) AS upto
      FROM turns),
    taken AS (SELECT source, place, count(*) AS copies FROM spent WHERE upto <= budget GROUP BY ALL)
    SELECT n.doc_id, n.size, t.source_size, t.target, (n.size * coalesce(k.copies, 0))::bigint AS taken
    FROM named n JOIN targets t ON n.source IS NOT DISTINCT FROM t.source
    LEFT JOIN taken k ON k.source IS NOT DISTINCT FROM n.source AND k.place = n.place
    """
