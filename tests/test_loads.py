"""Replacing slots: at one moment, or not at all."""

import pytest
from pyspark.sql import functions as F

from tagledger.plans.slot import create_silver_table
from tagledger.schemas import SILVER, Slot
from tagledger.session import glob_names
from tagledger.sinks.silver import register_partitions, replace_slot, settle_load, switch_partitions, write_load, write_silver
from tagledger.sources.loads import complete_loads, file_partitions, load_partitions
from tagledger.sources.silver import read_silver, read_silver_slot

SLOT, OTHER = Slot.parse("2024-01-01", "06"), Slot.parse("2024-01-01", "18")


def silver(spark, rows):
    """(category, name, price) as silver rows of the slot's day."""
    values = {c: F.lit(None) for c in SILVER.fieldNames()}
    values |= {"run_date": F.lit("2024-01-01"), "scraped_at": F.lit("2024-01-01 06:00:00"), "run_hour": F.lit("06")}
    df = spark.createDataFrame(rows, "category string, product_name string, current_price double")
    values |= {c: F.col(c) for c in df.columns}
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in SILVER.fields])


def seen(df):
    return sorted(((r["category"] or "", r["product_name"], r["current_price"]) for r in df.collect()))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "silver")


def test_a_write_that_fails_midway_changes_nothing(spark, root):
    replace_slot(silver(spark, [("a", "x", 1.0), ("b", "y", 2.0)]), root, SLOT)
    before = seen(read_silver(spark, root))
    rows = silver(spark, [("a", f"n{i}", float(i)) for i in range(400)]).repartition(8)
    bad = F.when(F.col("product_name") == "n399", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("current_price"))
    with pytest.raises(Exception, match="lost"):
        write_load(rows.withColumn("current_price", bad), root, SLOT)
    assert seen(read_silver(spark, root)) == before
    # Even where files of it are in place already, as after a commit that stopped.
    broken = f"{root}/load=2024-01-01-06.000002"
    silver(spark, [("a", "z", 9.0)]).write.mode("overwrite").partitionBy("category", "run_date", "run_hour").parquet(broken)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{broken}/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert seen(read_silver(spark, root)) == before
    # The next load of the slot clears it away.
    replace_slot(silver(spark, [("a", "x2", 3.0)]), root, SLOT)
    assert seen(read_silver(spark, root)) == [("a", "x2", 3.0), ("b", "y", 2.0)]
    assert not any("z" in name for _, name, _ in seen(read_silver(spark, root)))


def test_readers_between_the_two_moments(spark, root):
    write_silver(silver(spark, [("a", "appended", 1.0), (None, "n", 1.0)]), root)
    first = write_load(silver(spark, [("a", "one", 1.0), ("b", "two", 2.0)]), root, SLOT)
    assert seen(read_silver(spark, root)) == [("", "n", 1.0), ("a", "one", 1.0), ("b", "two", 2.0)]
    settle_load(spark, root, first, SLOT)
    second = write_load(silver(spark, [("a", "three", 3.0), (None, "m", 4.0)]), root, SLOT)
    assert complete_loads(spark, root) == [first, second]
    now = [("", "m", 4.0), ("a", "three", 3.0), ("b", "two", 2.0)]
    assert seen(read_silver(spark, root)) == now and seen(read_silver_slot(spark, root, SLOT)) == now
    settle_load(spark, root, second, SLOT)
    assert seen(read_silver(spark, root)) == now
    # What was replaced is gone, and a load without partitions as well.
    assert [p.category for p in load_partitions(spark, root, first)] == ["b"]
    replace_slot(silver(spark, [("b", "five", 5.0)]), root, SLOT)
    assert first not in complete_loads(spark, root)
    assert glob_names(spark, f"{root}/category=*/*/*") == []
    assert read_silver_slot(spark, root, OTHER).count() == 0


def test_the_table_switches_partition_by_partition(spark, root):
    table = "loads_switch"
    create_silver_table(spark, table, root)
    try:
        for rows in ([("o'a b", "x", 1.0), ("b", "y", 2.0)], [("o'a b", "z", 3.0)]):
            load = write_load(silver(spark, rows), root, SLOT)
            done = switch_partitions(spark, table, load_partitions(spark, root, load))
            assert [r.category for r in done] == sorted(r[0] for r in rows) or all(r.registered for r in done)
            assert all(r.registered for r in done)
            # The old folders are still there: the table has left them already.
            assert seen(spark.table(table)) == seen(read_silver(spark, root))
            settle_load(spark, root, load, SLOT)
        assert seen(spark.table(table)) == [("b", "y", 2.0), ("o'a b", "z", 3.0)]
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_partitions_come_from_file_names(spark, root, monkeypatch):
    replace_slot(silver(spark, [("a b%", "x", 1.0), (None, "y", 2.0)]), root, SLOT)
    write_silver(silver(spark, [("c", "x", 1.0), ("c", "y", 1.0)]), root)
    df = read_silver(spark, root)
    assert {p.key for p in file_partitions(df)} == {("a b%", "2024-01-01", "06"), (None, "2024-01-01", "06"), ("c", "2024-01-01", "06")}
    table = "loads_names"
    create_silver_table(spark, table, root)
    try:
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("register", "")
        assert all(r.registered for r in register_partitions(spark, table, df))
        assert not jobs.getJobIdsForGroup("register")  # no row is read
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3
        # Rows beside a load are in a second folder, which a table cannot show.
        write_silver(silver(spark, [("a b%", "late", 1.0)]), root)
        found = {r.category: r.registered for r in register_partitions(spark, table, read_silver(spark, root))}
        assert found == {"a b%": False, None: True, "c": True}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sql(f"DROP TABLE {table}")


def test_an_empty_load_replaces_nothing(spark, root):
    replace_slot(silver(spark, [("a", "x", 1.0)]), root, SLOT)
    assert replace_slot(silver(spark, []).filter("false"), root, SLOT) == 0
    assert seen(read_silver(spark, root)) == [("a", "x", 1.0)]
    late = silver(spark, [("a", "y", 1.0), ("b", "y", 1.0)]).withColumn("scraped_at", F.expr("timestamp '2024-01-03 00:00:00'"))
    assert replace_slot(late, root, SLOT) == 2
