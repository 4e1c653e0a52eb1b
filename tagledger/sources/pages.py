"""Listing pages to product records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.functions.markup import (
    TagRule,
    attribute,
    element_here,
    inner_html,
    near_element,
    plain_element,
    split_at_starts,
    starts_with_tag,
    whole_element,
)
from tagledger.functions.money import mrp_from_discount, parse_discount, parse_price, parse_rating
from tagledger.functions.text import decode_references, drop_hidden, element_text, resolve_url
from tagledger.operators.heavy import lookup_join
from tagledger.schemas import BRONZE_COLUMNS

MAX_PAGES = 2  # fixed value: pages read per listing


@dataclass(frozen=True)
class CardRules:
    """Where the fields of a product card are; the defaults are fixed values of the site."""

    base_url: str
    card: TagRule = field(default=TagRule("div", "sm-product"))
    name: TagRule = field(default=TagRule("a", "name", "part"))
    price: TagRule = field(default=TagRule("span", "price"))
    discount: TagRule = field(default=TagRule("span", "sm-pdrop"))
    rating: TagRule = field(default=TagRule("span", "sm-rating"))


def _only(df: DataFrame, condition: Callable[[DataFrame], Column]) -> DataFrame:
    """Rows of ``df`` that fulfil ``condition``, tested on columns already computed.

    A plain filter would be moved below the projections and there compute the
    same text functions a second time.
    """
    return df.select("*", F.explode(F.when(condition(df), F.array(F.lit(True)))).alias("_one")).drop("_one")


def extract_cards(
    pages: DataFrame,
    rules: CardRules,
    html: str = "html",
    keep: Sequence[str] = (),
    marker: str | None = None,
) -> DataFrame:
    """One row per card that has a name tag: ``keep``, name, url and the texts of its fields.

    A page without cards gives no rows.  A card inside another card counts as the
    next card; the outer one ends where it begins.  ``marker`` names a column that is true for one more row
    per page, without fields, so that pages can be counted where their cards are.
    """
    clean = pages.select(*keep, drop_hidden(F.col(html)).alias("_html"))
    pieces = split_at_starts(F.col("_html"), rules.card)
    if marker is None:
        segments = clean.select(*keep, F.explode(pieces).alias("_segment"))
        segments = segments.filter(starts_with_tag(F.col("_segment"), rules.card))
    else:
        # What is before the first card stands for the page.
        segments = clean.select(*keep, F.posexplode_outer(pieces).alias("_nth", "_segment"))
        page = F.coalesce(F.col("_nth") == 0, F.lit(True))
        segments = segments.select(*keep, page.alias(marker), F.when(~page, F.col("_segment")).alias("_segment"))
        segments = segments.filter(F.col(marker) | starts_with_tag(F.col("_segment"), rules.card))
        keep = [*keep, marker]
    # Each step is a projection of its own: a column used twice is computed once.
    plain = segments.select(*keep, "_segment", plain_element(F.col("_segment"), rules.card.tag).alias("_plain"))
    cards = plain.select(*keep, element_here(F.col("_plain"), F.col("_segment"), rules.card.tag).alias("_card"))
    fields = {"name": rules.name, "price": rules.price, "discount": rules.discount, "rating": rules.rating}
    near = cards.select(*keep, "_card", *[near_element(F.col("_card"), r).alias(n) for n, r in fields.items()])
    elements = near.select(*keep, *[whole_element(F.col(n), F.col("_card"), r).alias(n) for n, r in fields.items()])
    texts = elements.select(
        *keep,
        (F.col("name") != "").alias("_named"),
        attribute(F.col("name"), "href").alias("_href"),
        *[inner_html(F.col(n)).alias(n) for n in fields],
    )
    decoded = texts.select(
        *keep,
        "_named",
        element_text(F.col("name")).alias("product_name"),
        decode_references(F.col("_href")).alias("_href"),
        *[element_text(F.col(n)).alias(f"{n}_text") for n in ("price", "discount", "rating")],
    )
    cards_found = decoded.select(
        "*", resolve_url(rules.base_url, F.col("_href")).alias("product_url")
    )
    return _only(cards_found, lambda card: card["_named"] if marker is None else card["_named"] | card[marker]).select(
        *keep, "product_name", "product_url", "price_text", "discount_text", "rating_text"
    )


def card_records(cards: DataFrame, keep: Sequence[str] = (), marker: str | None = None) -> DataFrame:
    """Parse the texts of cards and drop those without a name or a price; rows of pages (``marker``) stay."""
    keep = [*keep, marker] if marker else keep
    parsed = cards.select(
        *keep,
        "product_name",
        "product_url",
        parse_price(F.col("price_text")).alias("current_price"),
        parse_discount(F.col("discount_text")).alias("discount_pct"),
        parse_rating(F.col("rating_text")).alias("rating"),
    )

    def complete(card: DataFrame) -> Column:
        full = (F.length(card["product_name"]) > 0) & (F.coalesce(card["current_price"], F.lit(0.0)) != 0)
        return full if marker is None else full | card[marker]

    return _only(parsed, complete).select(
        *keep,
        "product_name",
        "product_url",
        "current_price",
        mrp_from_discount(F.col("current_price"), F.col("discount_pct")).alias("mrp"),
        "discount_pct",
        "rating",
    )


def as_bronze(records: DataFrame, source: str) -> DataFrame:
    """Records with ``category`` and ``scraped_at`` in the bronze column order."""
    return records.withColumn("source", F.lit(source)).select(*BRONZE_COLUMNS)


def cut_pages(
    pages: DataFrame,
    max_pages: int = MAX_PAGES,
    listing: Sequence[str] = ("category",),
    page_num: str = "page_num",
    records: str = "n_records",
) -> DataFrame:
    """Keep pages 1 to ``max_pages`` of each listing, up to its first page without records."""
    near = pages.filter(F.col(page_num).between(1, max_pages))
    ends = (
        near.filter(F.col(records) == 0)
        .groupBy(*[F.col(c).alias(f"_{c}") for c in listing])
        .agg(F.min(page_num).alias("_end"))
    )
    same = F.lit(True)
    for c in listing:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    cut = lookup_join(near, ends, same)
    return cut.filter(F.col("_end").isNull() | (F.col(page_num) < F.col("_end"))).select(*pages.columns)
