"""One query per operator, each over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagledger.functions.markup import TagRule, split_at_starts
from tagledger.functions.money import mrp_from_discount, parse_discount, parse_price, parse_rating
from tagledger.functions.text import drop_hidden, resolve_url
from tagledger.operators import checks, dims, fact
from tagledger.operators.conform import cast_types, enrich, valid_rows
from tagledger.operators.dedupe import keep_one
from tagledger.operators.heavy import HOT_ROWS
from tagledger.operators.ordering import global_row_number, grouped_row_number
from tagledger.operators.trend import previous_value
from tagledger.plans.pages import land_pages, pages_to_bronze, read_listings
from tagledger.plans.silver import build_silver, silver_metrics
from tagledger.plans.slot import Paths, create_silver_table, load_slot, run_slot
from tagledger.schemas import BRONZE_COLUMNS, FACT_COLUMNS, SILVER_COLUMNS, Slot
from tagledger.session import pin_session, scratch_root, stage
from tagledger.sinks import tables
from tagledger.sinks.bronze import write_bronze
from tagledger.sinks.silver import register_partitions, replace_slot, write_silver
from tagledger.sources.bronze import read_bronze
from tagledger.sources.pages import CardRules, card_records, cut_pages, extract_cards
from tagledger.sources.silver import read_silver, staging
from tagledger.sources.spine import number_spine
from tagledger.suite.views import (
    SHOP,
    SHOP_RULES,
    damaged_pages,
    events_bronze,
    events_dirty,
    lineitem_bronze,
    lineitem_parts,
    listing_pages,
    table,
)

SLOT = Slot.parse("2024-01-01", "06")
LATER = Slot.parse("2024-01-01", "18")
# Inside the days of the events, so that some of them find no date key.
CALENDAR = (date(2024, 1, 5), 20)
PAGE_LIMIT = 400

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name without the ``q_`` that tells it from an operator."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_session(spark), sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__.removeprefix("q_")] = run
    return run


def _folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _database(spark: SparkSession, label: str) -> str:
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{_folder(spark, name)}'")
    return name


def _events_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(staging(build_silver(events_bronze(spark, sf_dir), SLOT)), "events")


def _lineitem_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(build_silver(lineitem_bronze(spark, sf_dir), SLOT))


# Silver


@query
def silver_typed(spark, sf_dir):
    return cast_types(events_dirty(spark, sf_dir))


@query
def silver_valid(spark, sf_dir):
    return valid_rows(cast_types(events_dirty(spark, sf_dir)))


@query
def q_silver_metrics(spark, sf_dir):
    return silver_metrics(events_dirty(spark, sf_dir), SLOT)


@query
def silver_metrics_lineitem(spark, sf_dir):
    return silver_metrics(lineitem_bronze(spark, sf_dir), SLOT)


@query
def silver_product_id(spark, sf_dir):
    some_null = F.when(F.col("category") != "PROMO", F.col("category"))
    bronze = lineitem_bronze(spark, sf_dir).withColumn("category", some_null)
    return enrich(cast_types(bronze)).select("product_url", "product_name", "category", "product_id")


@query
def silver_enriched(spark, sf_dir):
    enriched = enrich(valid_rows(cast_types(lineitem_bronze(spark, sf_dir))))
    return enriched.select(*[c for c in SILVER_COLUMNS if c != "run_hour"])


@query
def silver_dedupe(spark, sf_dir):
    enriched = enrich(valid_rows(cast_types(lineitem_bronze(spark, sf_dir))))
    columns = [c for c in SILVER_COLUMNS if c != "run_hour"]
    return keep_one(enriched.select(*columns), ["product_id", "scraped_at"], "copies")


@query
def silver_full(spark, sf_dir):
    return build_silver(events_bronze(spark, sf_dir), SLOT)


@query
def silver_full_dirty(spark, sf_dir):
    return build_silver(events_dirty(spark, sf_dir), SLOT)


@query
def silver_full_lineitem(spark, sf_dir):
    return build_silver(lineitem_bronze(spark, sf_dir), SLOT)


@query
def staging_projection(spark, sf_dir):
    root = _folder(spark, "silver")
    write_silver(build_silver(events_bronze(spark, sf_dir), SLOT), root)
    return staging(read_silver(spark, root))


# Dimensions


@query
def dim_category(spark, sf_dir):
    return dims.dim_category(_lineitem_staging(spark, sf_dir))


@query
def dim_platform(spark, sf_dir):
    return dims.dim_platform(_lineitem_staging(spark, sf_dir))


@query
def dim_product(spark, sf_dir):
    return dims.dim_product(_lineitem_staging(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    """The calendar over all ship dates of lineitem."""
    day = F.to_date("l_shipdate")
    first, last = table(spark, sf_dir, "lineitem").agg(F.min(day), F.max(day)).first()
    return dims.dim_date(spark, first, (last - first + timedelta(days=1)).days)


@query
def q_number_spine(spark, sf_dir):
    """Every user number up to the greatest, with its number of events."""
    events = table(spark, sf_dir, "events")
    top = events.agg(F.max("user_id")).first()[0]
    counts = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"))
    joined = number_spine(spark, top + 1).join(counts, F.col("n") == F.col("user_id"), "left")
    return joined.select("n", F.coalesce("c", F.lit(0)).cast("bigint").alias("n_events"))


# Fact


@query
def fact_star_join(spark, sf_dir):
    base = _events_staging(spark, sf_dir)
    star = fact.Dims(dims.dim_category(base), dims.dim_platform(base), dims.dim_date(spark, *CALENDAR))
    return fact.star_join(base, star)


@query
def fact_price_trend(spark, sf_dir):
    base = _lineitem_staging(spark, sf_dir).withColumnRenamed("product_id", "product_key")
    return fact.add_trend(base).select("product_key", "scraped_at", "current_price", "previous_price", "price_change")


@query
def fact_price_trend_hot(spark, sf_dir):
    """The same trend on the path for products with very many snapshots."""
    base = _lineitem_staging(spark, sf_dir).withColumnRenamed("product_id", "product_key")
    lagged = previous_value(
        base, "product_key", fact.history_order(), "current_price", "previous_price", hot_rows=100
    )
    change = (F.col("current_price") - F.col("previous_price")).alias("price_change")
    return lagged.select("product_key", "scraped_at", "current_price", "previous_price", change)


@query
def fact_snapshot_id(spark, sf_dir):
    base = _lineitem_staging(spark, sf_dir).select(
        F.col("product_id").alias("product_key"), "scraped_at", "run_date", "run_hour", "current_price"
    )
    return global_row_number(base, fact.sequence_order(), "snapshot_id")


def _fact(base: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    star = fact.Dims(
        dims.dim_category(base), dims.dim_platform(base), dims.dim_date(base.sparkSession, *CALENDAR)
    )
    return fact.build_fact(base, star, hot_rows)


@query
def fact_price_snapshots(spark, sf_dir):
    return _fact(_events_staging(spark, sf_dir))


@query
def fact_price_snapshots_lineitem(spark, sf_dir):
    silver = build_silver(lineitem_bronze(spark, sf_dir), SLOT)
    return _fact(stage(staging(silver), "lineitem"))


@query
def fact_price_snapshots_hot(spark, sf_dir):
    """The flagship with every product treated as a hot one."""
    return _fact(_events_staging(spark, sf_dir), hot_rows=1)


# Text to numbers


@query
def parse_money(spark, sf_dir):
    text = F.concat(F.lit(" ₹"), F.format_number("l_extendedprice", 2), F.lit(" "))
    items = table(spark, sf_dir, "lineitem")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", parse_price(text).alias("price"))


@query
def q_parse_discount(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    text = (
        F.when(F.col("event_type") == "error", F.concat(k, F.lit(".5%")))
        .when(F.col("event_type") == "view", F.lit(""))
        .otherwise(F.concat(F.lit(" "), k, F.lit(" % ")))
    )
    return table(spark, sf_dir, "events").select("event_id", parse_discount(text).alias("discount_pct"))


@query
def q_parse_rating(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.lit("new")).otherwise(
        F.concat(F.lit("\n"), (F.col("user_id") % 6).cast("string"), F.lit(".25 "))
    )
    return table(spark, sf_dir, "events").select("event_id", parse_rating(text).alias("rating"))


@query
def q_mrp_from_discount(spark, sf_dir):
    """Discounts 0 to 10 of lineitem, and ten times as much: 0, 100 and below 100."""
    items = lineitem_parts(spark, sf_dir)
    return items.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "price",
        "pct",
        mrp_from_discount(F.col("price"), F.col("pct")).alias("mrp"),
        mrp_from_discount(F.col("price"), F.col("pct") * 10).alias("mrp_tenfold"),
        mrp_from_discount(F.col("price"), F.col("pct") * 12).alias("mrp_twelvefold"),
    )


# Pages

LINK_CARD = TagRule("li")
LINK_RULES = CardRules(base_url=SHOP, card=LINK_CARD, name=TagRule("a"))


@query
def page_cards(spark, sf_dir):
    cards = extract_cards(table(spark, sf_dir, "pages"), LINK_RULES, keep=["page_id"])
    return cards.select("page_id", "product_name", "product_url")


@query
def page_urls(spark, sf_dir):
    """Links of the pages and their own addresses, made absolute."""
    pages = table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^https?://[^/]+(/.*)$", 1)
    return pages.select(
        "page_id",
        resolve_url(SHOP, F.col("url")).alias("absolute"),
        resolve_url(SHOP, path).alias("relative"),
        resolve_url(SHOP, F.nullif(path, path)).alias("missing"),
    )


@query
def page_cut(spark, sf_dir):
    """Pages numbered per language, cut at the first one without a bold paragraph start."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("category"),
        (F.size(split_at_starts(drop_hidden(F.col("html")), TagRule("b"))) - 1).cast("bigint").alias("n_records"),
    )
    numbered = grouped_row_number(pages, "category", [F.col("page_id").asc()], "page_num")
    return cut_pages(numbered, PAGE_LIMIT).select("page_id", "category", "page_num", "n_records")


@query
def page_cut_both(spark, sf_dir):
    """Many short listings: the limit of pages cuts some, the first page with at most five items others."""
    items = F.size(split_at_starts(drop_hidden(F.col("html")), LINK_CARD)) - 1
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat_ws("-", F.regexp_extract("html", '<html lang="([a-z]+)"', 1), (F.col("page_id") % 12).cast("string")).alias("category"),
        F.greatest(items - 5, F.lit(0)).cast("bigint").alias("n_records"),
    )
    numbered = grouped_row_number(pages, "category", [F.col("page_id").asc()], "page_num")
    return cut_pages(numbered, 4).select("page_id", "category", "page_num", "n_records")


@query
def listing_pages_parsed(spark, sf_dir):
    """The pages that were parsed at all: none behind a page without records, none over the limit."""
    return read_listings(listing_pages(spark, sf_dir), SHOP_RULES, max_pages=4).pages


@query
def listing_damaged(spark, sf_dir):
    """Cards with parts missing, open or odd, a kind per line number."""
    keep = ["category", "page_num", "scraped_at"]
    return card_records(extract_cards(damaged_pages(spark, sf_dir), SHOP_RULES, keep=keep), keep=keep)


@query
def listing_records(spark, sf_dir):
    keep = ["category", "page_num", "scraped_at"]
    return card_records(extract_cards(listing_pages(spark, sf_dir), SHOP_RULES, keep=keep), keep=keep)


@query
def listing_bronze(spark, sf_dir):
    return pages_to_bronze(listing_pages(spark, sf_dir), SHOP_RULES, "shop", max_pages=4)


# Checks


@query
def check_unique(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line")
    )
    orders = table(spark, sf_dir, "orders")
    return (
        checks.check_unique(items, "line")
        .withColumn("column", F.lit("line"))
        .unionByName(checks.check_unique(orders, "o_orderkey").withColumn("column", F.lit("o_orderkey")))
    )


@query
def check_not_null(spark, sf_dir):
    typed = cast_types(events_dirty(spark, sf_dir))
    return checks.check_not_null(typed, "product_name", "current_price", "mrp", "discount_pct", "scraped_at")


@query
def check_relationship(spark, sf_dir):
    """Line items whose order is missing among the orders not of status F."""
    open_orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    return checks.check_relationship(table(spark, sf_dir, "lineitem"), "l_orderkey", open_orders, "o_orderkey")


@query
def check_negative_mrp(spark, sf_dir):
    items = lineitem_parts(spark, sf_dir)
    return checks.check_empty(
        items.select(mrp_from_discount(F.col("price"), F.col("pct") * 12).alias("mrp")), "mrp < 0"
    )


@query
def check_report(spark, sf_dir):
    """All 22 checks on the star of the events; dates outside the calendar fail one."""
    base = _events_staging(spark, sf_dir)
    star = fact.Dims(
        dims.dim_category(base), dims.dim_platform(base), dims.dim_date(spark, *CALENDAR), dims.dim_product(base)
    )
    built = {
        "staging": base,
        "dim_category": star.category,
        "dim_platform": star.platform,
        "dim_date": star.date,
        "dim_product": star.product,
        "fact_price_snapshots": fact.build_fact(base, star),
    }
    return checks.run_checks(built, checks.STAR_CHECKS)


# Loading


@query
def bronze_roundtrip(spark, sf_dir):
    root = _folder(spark, "bronze")
    slot = write_bronze(events_dirty(spark, sf_dir), root, SLOT)
    return read_bronze(spark, root, "events", slot)


def _write_arrays(rows: DataFrame, root: str, slot: Slot, pretty: bool) -> None:
    """The collectors' form: arrays of objects, here one per category and minute."""
    options = {"ignoreNullFields": "false", "pretty": "true" if pretty else "false"}
    body = F.to_json(F.struct(*BRONZE_COLUMNS), options)
    minute = F.substring(F.coalesce("scraped_at", F.lit("")), 1, 16)
    listed = rows.groupBy("source", "category", minute.alias("minute")).agg(F.collect_list(body).alias("all"))
    comma, ends = (",\n", ("[\n", "\n]")) if pretty else (", ", ("[", "]"))
    value = F.concat(F.lit(ends[0]), F.array_join("all", comma), F.lit(ends[1])).alias("value")
    day = slot.run_date
    folders = {"year": str(day.year), "month": f"{day.month:02d}", "day": f"{day.day:02d}", "hour": slot.run_hour}
    placed = listed.select(value, "source", "category", *[F.lit(v).alias(n) for n, v in folders.items()])
    placed.write.mode("append").partitionBy("source", "category", *folders).text(root)


@query
def bronze_forms(spark, sf_dir):
    """Pretty arrays, arrays per line and objects per line in one slot, read without being told which is which."""
    root = _folder(spark, "bronze")
    rows = events_dirty(spark, sf_dir)
    pretty, dense = F.col("category").isin("click", "view"), F.col("category") == "error"
    _write_arrays(rows.filter(pretty), root, SLOT, True)
    _write_arrays(rows.filter(dense), root, SLOT, False)
    write_bronze(rows.filter(~pretty & ~dense), root, SLOT)
    return read_bronze(spark, root, "events", SLOT)


@query
def slot_replace(spark, sf_dir):
    """Two slots, the second one loaded twice."""
    root = _folder(spark, "silver")
    for slot in (SLOT, LATER, LATER):
        replace_slot(build_silver(events_bronze(spark, sf_dir), slot), root, slot)
    return read_silver(spark, root)


@query
def slot_load(spark, sf_dir):
    """Raw files to silver with the counts of the run beside the rows."""
    paths = Paths(_folder(spark, "bronze"), _folder(spark, "silver"), "events", _database(spark, "load"))
    write_bronze(events_dirty(spark, sf_dir), paths.bronze, SLOT)
    report = load_slot(spark, paths, SLOT)
    counts = [F.lit(report.metrics[n]).cast("bigint").alias(n) for n in sorted(report.metrics)]
    off_slot = F.lit(report.off_slot_rows).cast("bigint").alias("off_slot_rows")
    return read_silver(spark, paths.silver).select("*", *counts, off_slot)


def _with_counts(df: DataFrame, report) -> DataFrame:
    counts = {**report.metrics, "off_slot_rows": report.off_slot_rows}
    return df.select("*", *[F.lit(n).cast("bigint").alias(c) for c, n in sorted(counts.items())])


@query
def slot_load_invalid(spark, sf_dir):
    """A slot where no row is valid, after a good one: nothing is lost, and its rows are counted."""
    paths = Paths(_folder(spark, "bronze"), _folder(spark, "silver"), "events", _database(spark, "load"))
    write_bronze(events_bronze(spark, sf_dir), paths.bronze, SLOT)
    load_slot(spark, paths, SLOT)
    write_bronze(events_dirty(spark, sf_dir).filter("category in ('signup', 'error')"), paths.bronze, LATER)
    return _with_counts(read_silver(spark, paths.silver), load_slot(spark, paths, LATER))


@query
def slot_switch(spark, sf_dir):
    """A slot loaded from half of its files and again from all: what readers of the catalog table see."""
    paths = Paths(_folder(spark, "bronze"), _folder(spark, "silver"), "events", _database(spark, "switch"))
    rows = events_bronze(spark, sf_dir)
    early = F.substring("scraped_at", 12, 2) < "12"
    write_bronze(rows.filter(early), paths.bronze, SLOT)
    load_slot(spark, paths, SLOT)
    write_bronze(rows.filter(~early), paths.bronze, SLOT)
    report = load_slot(spark, paths, SLOT)
    return _with_counts(spark.table(paths.silver_table).select(*SILVER_COLUMNS), report)


@query
def q_register_partitions(spark, sf_dir):
    """Rows per partition, read through the catalog table."""
    root, database = _folder(spark, "silver"), _database(spark, "catalog")
    replace_slot(build_silver(events_bronze(spark, sf_dir), SLOT), root, SLOT)
    name = f"{database}.stg_price_snapshots"
    create_silver_table(spark, name, root)
    register_partitions(spark, name, read_silver(spark, root))
    rows = spark.table(name).groupBy("category", "run_date", "run_hour")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


@query
def materialize_full_refresh(spark, sf_dir):
    """A model stored twice, in each layout; the stored rows are the model's."""
    database = _database(spark, "models")
    base = _events_staging(spark, sf_dir)
    tables.materialize_table(base, f"{database}.t")
    again = tables.materialize_table(tables.sorted_layout(base, ["run_date", "product_id"]), f"{database}.t")
    keyed = tables.materialize_table(
        tables.keyed_layout(again, "product_id", ["run_date", "scraped_at"]), f"{database}.keyed"
    )
    bucketed = tables.materialize_bucketed(keyed, f"{database}.bucketed", "product_id", 8, ["scraped_at"])
    return tables.materialize_view(bucketed, f"v_{uuid.uuid4().hex}")


@query
def slot_run_fact(spark, sf_dir):
    """Two slots and a replay of the second through the whole job; the stored fact."""
    paths = Paths(_folder(spark, "bronze"), _folder(spark, "silver"), "events", _database(spark, "run"))
    rows = events_bronze(spark, sf_dir)
    early = F.substring("scraped_at", 12, 2) < "12"
    write_bronze(rows.filter(early), paths.bronze, SLOT)
    write_bronze(rows.filter(~early), paths.bronze, LATER)
    load_slot(spark, paths, SLOT)
    load_slot(spark, paths, LATER)
    report = run_slot(spark, paths, LATER, start=CALENDAR[0] - timedelta(days=10), days=40)
    return report.tables["fact_price_snapshots"].select(*FACT_COLUMNS)


@query
def pages_to_silver(spark, sf_dir):
    """Pages to bronze files to silver."""
    root = _folder(spark, "bronze")
    pages = listing_pages(spark, sf_dir).withColumns({"listing": F.col("category"), "category": F.lit("parts")})
    slot = land_pages(pages, SHOP_RULES, "shop", root, SLOT, max_pages=4, listing=["listing"])
    return build_silver(read_bronze(spark, root, "shop", slot), slot)
