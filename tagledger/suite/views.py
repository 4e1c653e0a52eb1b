"""Test tables in the shapes the operators read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagledger.functions.money import round2
from tagledger.schemas import BRONZE_COLUMNS
from tagledger.sources.pages import CardRules

SHOP = "https://shop.example"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in BRONZE_COLUMNS])


def _iso(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _discount(events_props: str = "props") -> Column:
    return F.get_json_object(events_props, "$.k")


def events_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean bronze row per event."""
    user = F.col("user_id").cast("string")
    return _text(
        table(spark, sf_dir, "events").select(
            F.concat(F.lit("item "), user).alias("product_name"),
            F.concat(F.lit("/item/"), user).alias("product_url"),
            F.col("value").alias("current_price"),
            F.lit(None).cast("string").alias("mrp"),
            _discount().alias("discount_pct"),
            (F.col("user_id") % 6).alias("rating"),
            F.col("event_type").alias("category"),
            F.lit("events").alias("source"),
            _iso(F.col("ts")).alias("scraped_at"),
        )
    )


def events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows with the defects raw files have, one kind per event type."""
    kind = F.col("category")
    return events_bronze(spark, sf_dir).withColumns(
        {
            "product_name": F.when(kind == "error", F.lit(None))
            .when(kind == "view", F.concat(F.lit("  "), "product_name", F.lit(" ")))
            .when(kind == "click", F.lit(""))
            .otherwise(F.concat("product_name", F.lit("\t"))),
            "current_price": F.when(kind == "signup", F.concat(F.lit("Rs "), "current_price"))
            .when((kind == "purchase") & (F.col("discount_pct") == "50"), F.lit("-5"))
            .when((kind == "purchase") & (F.col("discount_pct") == "51"), F.lit("NaN"))
            .otherwise(F.col("current_price")),
            "mrp": F.when(kind == "click", F.lit("")).when(kind == "purchase", F.lit("999.5")),
            "discount_pct": F.when(kind == "purchase", F.concat("discount_pct", F.lit(".5")))
            .when(kind == "click", F.lit("none"))
            .when(kind == "view", F.lit(None))
            .otherwise(F.col("discount_pct")),
            "rating": F.when(kind == "view", F.lit("n/a")).otherwise(F.col("rating")),
            "scraped_at": F.when(kind == "click", F.lit("zz")).otherwise(F.col("scraped_at")),
        }
    )


def lineitem_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = items.join(parts, items.l_partkey == parts.p_partkey)
    return joined.withColumn("price", round2(F.col("l_extendedprice") / F.col("l_quantity"))).withColumn(
        "pct", F.round(F.col("l_discount") * 100).cast("int")
    )


def lineitem_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of parts: many per product, and several with the same time."""
    return _text(
        lineitem_parts(spark, sf_dir).select(
            F.col("p_name").alias("product_name"),
            F.concat(F.lit("/part/"), F.col("l_partkey").cast("string")).alias("product_url"),
            F.col("price").alias("current_price"),
            F.lit(None).cast("string").alias("mrp"),
            F.col("pct").alias("discount_pct"),
            (F.col("l_quantity") / 10).alias("rating"),
            F.col("p_type").alias("category"),
            F.col("l_suppkey").alias("source"),
            _iso(F.col("l_shipdate")).alias("scraped_at"),
        )
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing page per lineitem row: the order is the listing, the line its page number.

    Lines of flag N have a page without a card.  Each page carries the things a
    parser must not fall for: a commented-out card, nested elements, references,
    a '>' in quotes and a price outside the card.
    """
    price = F.concat(F.lit("<i>&#8377;</i>"), F.format_number("price", 2))
    sold = F.concat(
        F.lit("<div data-x='a>b' class=\"big sm-product\" ><div class='pic'><span>x</span></div>"),
        F.lit("<a title=\"class='none'\" class=\"product-name-link\" href=\"/part/"),
        F.col("l_partkey").cast("string"),
        F.lit('?a=1&amp;b=2"> '),
        F.col("p_name"),
        F.lit(" &amp; <b>Co</b></a><span class='price'> "),
        price,
        F.lit(" </span>"),
        F.when(F.col("pct") > 0, F.format_string('<span class="sm-pdrop">%d%%</span>', "pct")).otherwise(""),
        F.lit('<SPAN CLASS="sm-rating">'),
        (F.col("l_quantity") / 10).cast("string"),
        F.lit("</SPAN></div><div class='ad'><span class='sm-pdrop'>99%</span></div>"),
    )
    hidden = F.lit("<!-- <div class='sm-product'><a class='name'>no</a><span class='price'>1</span></div> -->")
    card = F.when(F.col("l_returnflag") != "N", sold).otherwise(F.lit("<p>sold out</p>"))
    return lineitem_parts(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("category"),
        F.col("l_linenumber").alias("page_num"),
        _iso(F.col("l_shipdate")).alias("scraped_at"),
        F.concat(F.lit("<html><body>"), hidden, card, F.lit("</body></html>")).alias("html"),
    )


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card per lineitem row, damaged in one of seven ways by its line number.

    0: no link; 1: a price that is no number to pay; 2: a price too large for cents; 3: no name tag;
    4: nothing is closed; 5: references, known, unknown and bad; 6: a price in words.
    """
    kind = F.col("l_linenumber") % 7
    name = (
        F.when(kind == 0, F.concat(F.lit("<a class='name'>"), "p_name", F.lit("</a>")))
        .when(kind == 3, F.lit("<b>no name</b>"))
        .when(kind == 4, F.concat(F.lit("<a class=name href='/p'>"), "p_name", F.lit("</a>")))
        .when(kind == 5, F.concat(F.lit("<a class='name' href='/p?a&amp;b'>&Uuml;&laquo;&bogus;&#xD800;&amp;amp; "), "p_name", F.lit("</a>")))
        .otherwise(F.concat(F.lit("<a class='name' href='https://o/p'>"), "p_name", F.lit("</a>")))
    )
    price = (
        F.when(kind == 1, F.lit("NaN"))
        .when(kind == 2, F.lit("₹1,00,000,000,000,000,000.00"))
        .when(kind == 6, F.lit("soon"))
        .otherwise(F.format_number("price", 2))
    )
    discount = F.when(F.col("pct") > 0, F.format_string("<span class='sm-pdrop'>%d%%</span>", "pct")).otherwise("")
    closed = F.when(kind == 4, F.lit("")).otherwise(F.lit("</span></div></body></html>"))
    card = F.concat(F.lit("<html><body><div class='sm-product'>"), name, discount, F.lit("<span class='price'>"), price, closed)
    return lineitem_parts(spark, sf_dir).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")).alias("category"),
        F.col("l_linenumber").alias("page_num"),
        _iso(F.col("l_shipdate")).alias("scraped_at"),
        card.alias("html"),
    )


SHOP_RULES = CardRules(base_url=SHOP)
