import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagledger.operators.heavy import fits_broadcast, heavy_keys, heavy_tables, heavy_values, lookup_join
from tagledger.operators.ordering import global_row_number, grouped_row_number, sorted_runs
from tagledger.operators.trend import previous_value


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, a third copies of one row, some nulls."""
    rnd = random.Random(7)
    rows = [("hot", rnd.randrange(10_000), rnd.random()) for _ in range(2000)]
    rows += [("copy", 5, 1.0)] * 2000
    rows += [(f"k{rnd.randrange(300)}", rnd.randrange(50), rnd.random()) for _ in range(1900)]
    rows += [(None, None, None)] * 60 + [("hot", None, 2.0)] * 40
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, v double").repartition(7)


@pytest.fixture
def no_coalescing(spark):
    """Many runs even for few rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def total_order():
    return [F.col(c).asc_nulls_last() for c in ("k", "t", "v")]


@pytest.mark.parametrize("spread", [True, False])
def test_global_row_number_is_the_naive_one(skewed, no_coalescing, spread):
    found = global_row_number(skewed, total_order(), "n", spread_copies=spread)
    naive = skewed.withColumn("n", F.row_number().over(Window.orderBy(*total_order())).cast("bigint"))
    assert found.dtypes[0] == ("n", "bigint")
    want = sorted(tuple(r) for r in naive.select("n", "k", "t", "v").collect())
    assert sorted(tuple(r) for r in found.collect()) == want


def test_copies_are_spread_over_runs(skewed, no_coalescing):
    sizes = sorted_runs(skewed, total_order()).groupBy("_run").count()
    assert sizes.count() == 8 and sizes.agg(F.max("count")).first()[0] < 2000


def test_runs_follow_the_order(skewed, no_coalescing):
    runs = sorted_runs(skewed.filter("k is not null and t is not null"), total_order())
    ends = runs.groupBy("_run").agg(F.min(F.struct("k", "t", "v")).alias("lo"), F.max(F.struct("k", "t", "v")).alias("hi"))
    rows = sorted(ends.collect(), key=lambda r: r["_run"])
    assert all(tuple(a["hi"]) <= tuple(b["lo"]) for a, b in zip(rows, rows[1:]))


def test_row_number_of_nothing(spark):
    assert global_row_number(spark.createDataFrame([], "a int"), [F.col("a").asc()], "n").count() == 0


def test_grouped_row_number(skewed, no_coalescing):
    found = grouped_row_number(skewed, "k", [F.col("t").asc_nulls_last(), F.col("v").asc_nulls_last()], "n")
    by = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("v").asc_nulls_last())
    want = skewed.withColumn("n", F.row_number().over(by).cast("bigint")).select("n", "k", "t", "v")
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(key, found.collect())) == sorted(map(key, want.collect()))


@pytest.mark.parametrize("hot_rows", [1, 1500, 10**9])
def test_previous_value_is_the_naive_one(skewed, no_coalescing, hot_rows):
    order = [F.col("t").asc_nulls_last(), F.col("v").asc_nulls_last()]
    found = previous_value(skewed, "k", order, "v", "p", hot_rows=hot_rows)
    naive = skewed.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy(*order)))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(key, found.select("k", "t", "v", "p").collect())) == sorted(map(key, naive.select("k", "t", "v", "p").collect()))


def test_heavy_keys(skewed):
    assert set(heavy_keys(skewed, "k", 1500)) == {"hot", "copy"}
    assert heavy_keys(skewed, "k", 10**6) == []
    both = heavy_values(skewed, {"a": F.col("k"), "b": F.xxhash64("k", "t", "v")}, 1500)
    assert set(both["a"]) == {"hot", "copy"} and len(both["b"]) == 1


def test_heavy_keys_of_nothing(spark):
    assert heavy_keys(spark.createDataFrame([], "k string"), "k") == []


def test_lookup_join_is_the_same_on_both_ways(spark, skewed):
    names = skewed.select("k").distinct().filter("k is not null").select(F.col("k").alias("name"), F.length("k").alias("len"))
    assert fits_broadcast(names, 500) and not fits_broadcast(names, 5)
    on = F.col("k") == F.col("name")
    small, large = (lookup_join(skewed, names, on, max_rows=n) for n in (500, 5))
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    assert small.count() == skewed.count()


def test_no_top_of_heavy_keys(spark):
    keys = spark.range(24_000).select((F.col("id") % 8_000).alias("k"))
    assert sorted(heavy_keys(keys, "k", 3)) == list(range(8_000))


def test_broadcast_is_checked_by_bytes(spark):
    wide = spark.range(10).select(F.lit("x" * 1000).alias("t"))
    assert fits_broadcast(wide, 10, 20_000) and not fits_broadcast(wide, 10, 5_000)


def test_heavy_keys_are_exact_among_many(spark):
    """Keys whose share is far below what a sketch of fixed size can tell, and shared hash ranges."""
    many = spark.range(300_000).select((F.col("id") % 150_000).alias("k"))
    some = spark.range(40).select((F.col("id") * 7).alias("k"))
    found = heavy_tables(many.unionByName(some), {"k": F.col("k"), "none": F.lit(None).cast("long")}, 3)
    assert sorted(r["value"] for r in found["k"].collect()) == [7 * i for i in range(40)]
    assert {r["n"] for r in found["k"].collect()} == {3} and found["none"].isEmpty()
    few = heavy_tables(many, {"k": F.col("k")}, 3, ranges=8)["k"]
    assert few.isEmpty()


def test_trend_joins_its_hot_keys_as_a_table(spark, skewed, no_coalescing):
    hot = heavy_tables(skewed, {"k": F.col("k")}, 1500)["k"]
    order = [F.col("t").asc_nulls_last(), F.col("v").asc_nulls_last()]
    found = previous_value(skewed, "k", order, "v", "p", hot=hot)
    naive = skewed.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy(*order)))
    assert found.count() == naive.count() and found.exceptAll(naive.select(*found.columns)).isEmpty()
