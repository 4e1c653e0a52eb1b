"""JSON objects of text files of any form, read by many tasks per file.

A file is read as pieces of text that each end at a closing brace, wherever its byte ranges are cut.  Whether a
brace is one of the data or stands inside a string depends on what comes before it, so two
numbers are carried from piece to piece: quotes (an odd number means inside a string) and depth of braces.
Inside a byte range they are running sums; between the ranges of a file only one short row
per range is needed, with its sums for either state at its start.  An object is the text from where
the depth leaves zero to where it comes back; most are a single piece and stay where they were read.

Read this way: arrays of objects, pretty-printed or not, one object or array per line, objects
one after the other, objects in objects.  Strings are in double quotes.  An object that is cut
off by the end of its file is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagledger.operators.heavy import lookup_join
from tagledger.session import stage

_STRING = r'"[^"]*(?:"|\z)'
_REST_OF_STRING = r'^[^"]*(?:"|\z)'
RANGE = ("file", "block")


def _number_of(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Pieces with their place, and what each does to quotes and depth from either state before it."""
    read = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("piece"),
    )
    bare = F.regexp_replace("piece", r"(?s)\\.", "")
    marked = read.withColumn("_bare", bare)
    outside = F.regexp_replace("_bare", _STRING, "")
    inside = F.regexp_replace(F.regexp_replace("_bare", _REST_OF_STRING, ""), _STRING, "")
    odd = _number_of(F.col("_bare"), '"') % 2
    return marked.select(
        "file", "size", "block", "at", "piece",
        odd.alias("odd"),
        _number_of(outside, "{").alias("open0"),
        _number_of(inside, "{").alias("open1"),
    )


def _either(odd: Column, zero: Column, one: Column) -> Column:
    return F.when(odd == 0, zero).otherwise(one)


def _inside_ranges(pieces: DataFrame) -> DataFrame:
    """Running sums inside each byte range, for both states at its start: 0 outside, 1 inside a string."""
    order = Window.partitionBy(*RANGE).orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    stated = pieces.withColumn("_in", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # A brace that ends a piece closes something if no string is open there.
    change = {n: F.col(f"open{n}") - F.when((F.col("odd") + n) % 2 == 0, 1).otherwise(0) for n in (0, 1)}
    for start in (0, 1):
        state = (F.col("_in") + start) % 2
        stated = stated.withColumns(
            {f"change{start}": _either(state, change[0], change[1]), f"opens{start}": _either(state, F.col("open0"), F.col("open1"))}
        )
    summed = {f"depth{n}": F.sum(f"change{n}").over(upto) for n in (0, 1)}
    return stated.withColumns(summed).drop("_in", "open0", "open1")


def _carried(ranges: DataFrame) -> DataFrame:
    """State at the start of every byte range, and where a file ends without a brace."""
    sums = ranges.groupBy(*RANGE).agg(
        F.sum("odd").alias("odd"),
        F.sum("change0").alias("change0"),
        F.sum("change1").alias("change1"),
        F.sum(F.octet_length("piece") + 1).alias("bytes"),
        F.max("at").alias("last"),
        F.first("size").alias("size"),
    )
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    state = sums.withColumn("start", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    own = _either(F.col("start"), F.col("change0"), F.col("change1"))
    cut = (F.sum("bytes").over(whole) > F.col("size")) & (F.col("block") == F.max("block").over(whole))
    return state.withColumn("_own", own).select(
        F.col("file").alias("_file"),
        F.col("block").alias("_block"),
        "start",
        F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("base"),
        F.when(cut, F.col("last")).alias("unclosed"),
    )


def _same_range() -> Column:
    return (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))


def _joined(parts: DataFrame) -> DataFrame:
    """Objects of several pieces: pieces are numbered by the object that they are of, and put together."""
    starts = parts.filter("first").groupBy(*RANGE).agg(F.count("*").alias("n"))
    ranges = parts.select(*RANGE).distinct().join(starts.withColumnsRenamed({"file": "_file", "block": "_block"}), _same_range(), "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sooner = ranges.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_sooner")
    )
    own = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    counted = parts.withColumn("_own", F.sum(F.col("first").cast("int")).over(own))
    numbered = lookup_join(counted, sooner, _same_range()).withColumn("_object", F.col("_sooner") + F.col("_own"))
    listed = F.array_sort(F.collect_list(F.struct("block", "at", "piece", "last")))
    whole = numbered.groupBy("file", "_object").agg(listed.alias("_parts")).filter(F.exists("_parts", lambda p: p["last"]))
    return whole.select(F.concat(F.array_join(F.transform("_parts", lambda p: p["piece"]), "}"), F.lit("}")).alias("text"))


def json_objects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per top-level JSON object of the files: its ``text``."""
    ranges = stage(_inside_ranges(_pieces(spark, paths)), "json-pieces")
    placed = lookup_join(ranges, _carried(ranges), _same_range())
    after = F.col("base") + _either(F.col("start"), F.col("depth0"), F.col("depth1"))
    change = _either(F.col("start"), F.col("change0"), F.col("change1"))
    opens = _either(F.col("start"), F.col("opens0"), F.col("opens1"))
    known = placed.filter(F.col("unclosed").isNull() | (F.col("at") < F.col("unclosed"))).select(
        *RANGE, "at", "piece", (after - change).alias("before"), after.alias("after"), opens.alias("opens")
    )
    first = (F.col("before") == 0) & (F.col("opens") > 0)
    # What stands before an object at depth zero: brackets, commas, blanks.
    text = F.when(first, F.regexp_replace("piece", r"^[^{]*", "")).otherwise(F.col("piece"))
    marked = known.select(*RANGE, "at", text.alias("piece"), first.alias("first"), (F.col("after") == 0).alias("last"), "before")
    single = marked.filter("first and last").select(F.concat("piece", F.lit("}")).alias("text"))
    parts = marked.filter("(first and not last) or before > 0")
    return single.unionByName(_joined(parts))
