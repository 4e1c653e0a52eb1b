import math

import pytest
from pyspark.sql import functions as F

from tagledger.operators.conform import cast_types, enrich, valid_rows
from tagledger.operators.dedupe import keep_latest, keep_one
from tagledger.plans.silver import build_silver, silver_metrics
from tagledger.schemas import BRONZE, BRONZE_COLUMNS, SILVER_COLUMNS, Slot

SLOT = Slot.parse("2026-08-04", 6)
GOOD = {
    "product_name": "Apple iPhone 15",
    "product_url": "https://h/x",
    "current_price": "97999.0",
    "mrp": None,
    "discount_pct": None,
    "rating": "4.15",
    "category": "smartphones",
    "source": "shop",
    "scraped_at": "2026-08-04T06:01:02.123456",
}


@pytest.fixture
def bronze(spark):
    def make(*changes):
        rows = [tuple({**GOOD, **c}[n] for n in BRONZE_COLUMNS) for c in changes]
        return spark.createDataFrame(rows, BRONZE)

    return make


@pytest.mark.parametrize("price", ["abc", None, "0", "-5", ""])
def test_bad_price_is_dropped_and_counted(bronze, price):
    rows = bronze({}, {"current_price": price})
    assert build_silver(rows, SLOT).count() == 1
    assert silver_metrics(rows, SLOT).first().asDict() == {
        "raw_rows": 2, "valid_rows": 1, "invalid_rows": 1, "deduped_rows": 1,
    }


def test_nan_price_and_empty_name_pass(bronze):
    rows = build_silver(bronze({"current_price": "NaN"}, {"product_name": " "}, {"product_name": None}), SLOT).collect()
    by_name = {r["product_name"]: r for r in rows}
    assert set(by_name) == {"Apple iPhone 15", ""}
    assert math.isnan(by_name["Apple iPhone 15"]["current_price"]) and by_name[""]["brand"] == ""


def test_types_and_defaults(bronze):
    row = build_silver(bronze({}), SLOT).first()
    assert tuple(row.asDict()) == SILVER_COLUMNS
    assert (row["mrp"], row["discount_pct"], row["has_discount"]) == (97999.0, 0, False)
    assert (row["brand"], row["is_rating_available"], row["run_hour"]) == ("Apple", True, "06")
    assert str(row["scraped_at"]) == "2026-08-04 06:01:02.123456" and str(row["run_date"]) == "2026-08-04"


def test_bad_text_becomes_null(bronze):
    row = cast_types(bronze({"mrp": "x", "discount_pct": "7.5", "rating": "none", "scraped_at": "zz"})).first()
    assert (row["mrp"], row["discount_pct"], row["rating"], row["scraped_at"]) == (None, 7, None, None)
    assert cast_types(bronze({"scraped_at": "2026-08-04T06:01:02"})).first()["scraped_at"] is not None


def test_flags(bronze):
    rows = enrich(valid_rows(cast_types(bronze({"discount_pct": "7", "rating": "0"}, {"discount_pct": "0", "rating": None}))))
    assert [(r["has_discount"], r["is_rating_available"]) for r in rows.collect()] == [(True, False), (False, False)]


def test_duplicates_keep_the_smallest_row(bronze):
    rows = bronze({"current_price": "5"}, {"current_price": "3"}, {"product_url": "https://h/a", "current_price": "9"})
    (kept,) = build_silver(rows, SLOT).collect()
    assert (kept["product_url"], kept["current_price"]) == ("https://h/a", 9.0)


def test_other_time_is_another_row(bronze):
    rows = bronze({}, {"scraped_at": "2026-08-04T06:02:00"}, {"scraped_at": None}, {"scraped_at": "zz"})
    assert build_silver(rows, SLOT).count() == 3


def test_padded_names_are_one_product(bronze):
    ids = {r["product_id"] for r in build_silver(bronze({"product_name": " Apple X "}, {"product_name": "apple x"}), SLOT).collect()}
    assert len(ids) == 1


def test_metrics_add_up_with_copies(bronze):
    rows = bronze(*[{}] * 50, *[{"current_price": None}] * 30, {"product_name": "B"})
    assert silver_metrics(rows, SLOT).first().asDict() == {
        "raw_rows": 81, "valid_rows": 51, "invalid_rows": 30, "deduped_rows": 2,
    }


def test_keep_one_counts_copies(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (None, "y")], "k int, v string")
    assert {tuple(r) for r in keep_one(df, ["k"], "n").collect()} == {(1, "a", 2), (None, "y", 2)}


def test_keep_latest(spark):
    rows = [(1, "2026-01-01", "old"), (1, "2026-01-02", "new"), (2, None, "undated"), (2, "2026-01-02", "dated")]
    df = spark.createDataFrame(rows, "k int, t string, v string").withColumn("t", F.to_timestamp("t"))
    assert {tuple(r) for r in keep_latest(df, "k", "t", [], ["v"]).collect()} == {(1, "new"), (2, "undated")}
