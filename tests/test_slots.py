import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tagledger.plans.silver import build_silver
from tagledger.plans.slot import Paths, create_silver_table, run_slot
from tagledger.schemas import BRONZE_COLUMNS, SILVER, Slot
from tagledger.sinks.bronze import write_bronze
from tagledger.sinks.silver import register_partitions, replace_slot, write_silver
from tagledger.sources.bronze import read_bronze, slot_exists
from tagledger.sources.silver import read_silver

MORNING, EVENING = Slot.parse("2026-08-04", "06"), Slot.parse("2026-08-04", "18")


def product(name, price, at, **more):
    return {
        "product_name": name, "product_url": f"https://h/{name}", "current_price": price, "mrp": None,
        "discount_pct": None, "rating": None, "category": "phones", "source": "shop", "scraped_at": at, **more,
    }


def land(root, slot, rows, category="phones", file="a"):
    """A file as the site's collector writes it: one array over many lines."""
    folder = root / "source=shop" / f"category={category}" / slot.folder
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{file}.json").write_text(json.dumps(rows, ensure_ascii=False, indent=2))


@pytest.fixture
def paths(tmp_path, spark):
    database = f"db_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path / 'db'}'")
    yield Paths(str(tmp_path / "bronze"), str(tmp_path / "silver"), "shop", database)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def names(spark, paths):
    rows = read_silver(spark, paths.silver).collect()
    return sorted((r["run_hour"], r["category"], r["product_name"], r["current_price"]) for r in rows)


def test_slot_text():
    assert MORNING.folder == "year=2026/month=08/day=04/hour=06"
    assert Slot.parse("2026-08-04", 6) == MORNING
    for bad in [("04-08-2026", "06"), ("2026-08-04", "24"), ("2026-08-04", "x")]:
        with pytest.raises(ValueError):
            Slot.parse(*bad)


def test_read_arrays_of_all_categories(spark, tmp_path):
    land(tmp_path, MORNING, [product("a", 1.5, "2026-08-04T06:00:01"), product("b", 2, "2026-08-04T06:00:01")])
    land(tmp_path, MORNING, [product("c", 3.0, "2026-08-04T06:00:02", category="laptops")], "laptops")
    land(tmp_path, EVENING, [product("d", 4.0, "2026-08-04T18:00:02")])
    rows = read_bronze(spark, str(tmp_path), "shop", MORNING)
    assert rows.columns == list(BRONZE_COLUMNS)
    assert sorted((r["product_name"], r["category"], r["current_price"]) for r in rows.collect()) == [
        ("a", "phones", "1.5"), ("b", "phones", "2"), ("c", "laptops", "3.0"),
    ]


def test_lines_layout_is_whole(spark, tmp_path):
    rows = [tuple(product(f"p{i}", str(i), "2026-08-04T06:00:01")[c] for c in BRONZE_COLUMNS) for i in range(100)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BRONZE_COLUMNS)).coalesce(1)
    write_bronze(df, str(tmp_path / "b"), MORNING)
    back = read_bronze(spark, str(tmp_path / "b"), "shop", MORNING, layout="lines")
    assert back.exceptAll(df).isEmpty() and back.count() == 100
    with pytest.raises(ValueError):
        read_bronze(spark, str(tmp_path), "shop", MORNING, layout="csv")


def test_empty_slot_changes_nothing(spark, paths, tmp_path):
    assert not slot_exists(spark, paths.bronze, "shop", MORNING)
    assert read_bronze(spark, paths.bronze, "shop", MORNING).count() == 0
    report = run_slot(spark, paths, MORNING)
    assert not report.loaded and not (tmp_path / "silver").exists()


def test_run_two_slots_and_a_replay(spark, paths, tmp_path):
    bronze = tmp_path / "bronze"
    land(bronze, MORNING, [product("a", 10.0, "2026-08-04T06:00:00"), product("b", 0, "2026-08-04T06:00:00")])
    land(bronze, MORNING, [product("l", 7.0, "2026-08-04T06:00:00", category="laptops")], "laptops")
    land(bronze, EVENING, [product("a", 12.0, "2026-08-04T18:00:00", product_url="https://h/new")])
    first = run_slot(spark, paths, MORNING)
    assert first.metrics == {"raw_rows": 3, "valid_rows": 2, "invalid_rows": 1, "deduped_rows": 2}
    assert {(p.category, p.run_hour, p.registered) for p in first.partitions} == {("phones", "06", True), ("laptops", "06", True)}
    run_slot(spark, paths, EVENING)
    before = names(spark, paths)
    again = run_slot(spark, paths, EVENING)
    assert names(spark, paths) == before and again.off_slot_rows == 0
    assert len(again.checks) == 22 and again.passed
    fact = again.tables["fact_price_snapshots"].filter("run_hour = '18'").first()
    assert (fact["previous_price"], fact["price_change"], fact["date_key"]) == (10.0, 2.0, 20260804)
    assert fact["snapshot_id"] in (1, 2, 3)
    newest = again.tables["dim_product"].filter("product_name = 'a'").first()
    assert newest["product_url"] == "https://h/new"
    assert spark.table(paths.silver_table).count() == 3


def test_two_files_of_one_slot_are_both_kept(spark, paths, tmp_path):
    land(tmp_path / "bronze", MORNING, [product("a", 10.0, "2026-08-04T06:00:00")], file="try1")
    land(tmp_path / "bronze", MORNING, [product("a", 10.0, "2026-08-04T06:05:00")], file="try2")
    run_slot(spark, paths, MORNING)
    assert len(names(spark, paths)) == 2


def test_replay_with_other_scrape_day(spark, paths, tmp_path):
    """The rows go to the slot's day, so a second replay replaces the first."""
    bronze = tmp_path / "bronze"
    land(bronze, Slot.parse("2026-08-05", "06"), [product("x", 1.0, "2026-08-05T06:00:00")])
    run_slot(spark, paths, Slot.parse("2026-08-05", "06"))
    land(bronze, MORNING, [product("a", 10.0, "2026-08-05T09:00:00"), product("b", 1.0, "zz")])
    for _ in range(2):
        report = run_slot(spark, paths, MORNING)
    assert report.off_slot_rows == 2
    found = {(r["run_date"], r["product_name"]) for r in read_silver(spark, paths.silver).collect()}
    assert found == {(date(2026, 8, 5), "x"), (date(2026, 8, 4), "a"), (date(2026, 8, 4), "b")}


def test_absent_categories_stay(spark, paths, tmp_path):
    bronze = tmp_path / "bronze"
    land(bronze, MORNING, [product("a", 1.0, "2026-08-04T06:00:00")])
    land(bronze, MORNING, [product("l", 2.0, "2026-08-04T06:00:00", category="laptops")], "laptops")
    run_slot(spark, paths, MORNING)
    only = read_bronze(spark, paths.bronze, "shop", MORNING).filter("category = 'phones'").withColumn("current_price", F.lit("5"))
    replace_slot(build_silver(only, MORNING), paths.silver, MORNING)
    assert names(spark, paths) == [("06", "laptops", "l", 2.0), ("06", "phones", "a", 5.0)]


def test_all_invalid_slot(spark, paths, tmp_path):
    land(tmp_path / "bronze", MORNING, [product("a", "soon", "2026-08-04T06:00:00")])
    report = run_slot(spark, paths, MORNING)
    assert report.loaded and report.metrics["invalid_rows"] == 1 and report.passed
    assert report.tables["fact_price_snapshots"].count() == 0


def test_date_outside_the_calendar_fails_its_check(spark, paths, tmp_path):
    slot = Slot.parse("2028-01-01", "06")
    land(tmp_path / "bronze", slot, [product("a", 1.0, "2028-01-01T06:00:00")])
    report = run_slot(spark, paths, slot, staging_as="table")
    failed = [(c["test"], c["column"], c["failures"]) for c in report.checks if not c["passed"]]
    assert failed == [("not_null", "date_key", 1)]
    assert report.tables["fact_price_snapshots"].first()["date_key"] is None


def test_append_keeps_rows(spark, paths, tmp_path):
    land(tmp_path / "bronze", MORNING, [product("a", 1.0, "2026-08-04T06:00:00")])
    silver = build_silver(read_bronze(spark, paths.bronze, "shop", MORNING), MORNING)
    write_silver(silver, paths.silver)
    write_silver(silver, paths.silver)
    assert read_silver(spark, paths.silver).count() == 2
    assert {(f.name, f.dataType) for f in read_silver(spark, paths.silver).schema} == {(f.name, f.dataType) for f in SILVER}


def test_registration_reports_failures(spark, paths, tmp_path):
    rows = [("o'hara", date(2026, 8, 4), "06"), ("b", date(2026, 8, 4), "06")]
    df = spark.createDataFrame(rows, "category string, run_date date, run_hour string")
    missing = register_partitions(spark, f"{paths.database}.nowhere", df)
    assert len(missing) == 2 and not any(r.registered for r in missing) and all(r.message for r in missing)
    create_silver_table(spark, paths.silver_table, paths.silver)
    for _ in range(2):
        assert all(r.registered for r in register_partitions(spark, paths.silver_table, df))
    assert spark.sql(f"SHOW PARTITIONS {paths.silver_table}").count() == 2
