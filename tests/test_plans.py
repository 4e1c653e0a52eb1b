"""The plans stay the ones the operators were written for."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagledger.operators import dims, fact
from tagledger.operators.ordering import global_row_number, sorted_runs
from tagledger.plans.silver import build_silver
from tagledger.plans.star import refresh_star
from tagledger.session import stage
from tagledger.sources.pages import CardRules, card_records, extract_cards
from tagledger.sources.silver import staging
from tagledger.suite.queries import SLOT
from tagledger.suite.views import events_bronze, table

SF_DIR = "/root/testdata/sf0.001"


def plan(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def base(spark):
    return stage(staging(build_silver(events_bronze(spark, SF_DIR), SLOT)), "plans")


@pytest.fixture(scope="module")
def star(spark, base):
    return fact.Dims(dims.dim_category(base), dims.dim_platform(base), dims.dim_date(spark))


def test_dimensions_are_broadcast(base, star, capsys):
    text = plan(fact.star_join(base, star), capsys, "simple")
    # Three dimensions, and the run sizes inside two of them.
    assert len(re.findall("BroadcastHashJoin .*LeftOuter", text)) == 3
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_fact_has_no_single_task_over_its_rows(base, star, capsys):
    text = plan(fact.build_fact(base, star), capsys, "simple")
    assert text.count("Exchange SinglePartition") == 1
    below = text[text.index("Exchange SinglePartition"):]
    assert "HashAggregate(keys=[_run" in below.splitlines()[1]
    assert text.count("hashpartitioning(product_key") == 1


def test_no_python_in_any_core_plan(base, star, capsys):
    pages = table(base.sparkSession, SF_DIR, "pages")
    for df in (
        build_silver(events_bronze(base.sparkSession, SF_DIR), SLOT),
        fact.build_fact(base, star),
        dims.dim_product(base),
        card_records(extract_cards(pages, CardRules("https://h"))),
    ):
        text = plan(df, capsys)
        # Not "Arrow" alone: the table of character references in the page plan names arrows.
        assert not re.search("Python|Pandas|InArrow", text)


def test_silver_shuffles_once(spark, capsys):
    text = plan(build_silver(events_bronze(spark, SF_DIR), SLOT), capsys, "simple")
    assert text.count("Exchange") == 1 and "partial_min" in text


def test_scans_read_what_is_used(base, capsys):
    text = plan(base.select(F.col("category").alias("c")).distinct(), capsys)
    assert re.search(r"ReadSchema: struct<category:string>\s", text)
    text = plan(dims.dim_product(base), capsys)
    assert "current_price" not in re.search("ReadSchema: (.*)", text)[1]


def test_filters_reach_the_scan(base, capsys):
    text = plan(base.filter("current_price > 100").select("product_id"), capsys)
    assert "GreaterThan(current_price,100.0)" in text


def test_copies_are_numbered_in_sorted_order(base, capsys, monkeypatch):
    """The local sort below the range shuffle must survive the optimizer."""
    from tagledger.operators import ordering

    seen = []
    monkeypatch.setattr(ordering, "stage", lambda df, label: seen.append(df) or stage(df, label))
    sorted_runs(base, [F.col("run_date").asc_nulls_last()])
    text = plan(seen[0], capsys, "simple")
    assert text.count("Sort [") == 2 and text.count("rangepartitioning") == 1


def test_numbers_need_no_second_shuffle(base, capsys):
    text = plan(global_row_number(base, [F.col("run_date").asc_nulls_last()], "n"), capsys, "simple")
    assert "rangepartitioning" not in text and text.count("hashpartitioning") == 1


def test_stored_fact_is_joined_and_ranked_without_a_shuffle(spark, base, tmp_path, capsys):
    database = "plans_star"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path / 'db'}'")
    try:
        tables = refresh_star(base, database)
        stored, products = tables["fact_price_snapshots"], tables["dim_product"]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = stored.join(products, "product_key")
        assert "SortMergeJoin" in plan(joined, capsys, "simple") and "Exchange" not in plan(joined, capsys, "simple")
        before = F.lag("current_price").over(Window.partitionBy("product_key").orderBy(*fact.history_order()))
        lagged = stored.withColumn("again", before)
        assert "Exchange" not in plan(lagged, capsys, "simple")
        assert lagged.filter(~F.col("again").eqNullSafe(F.col("previous_price"))).isEmpty()
        assert joined.count() == stored.count() == base.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP DATABASE {database} CASCADE")
