"""Pages to bronze records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.operators.heavy import lookup_join
from tagledger.schemas import Slot
from tagledger.session import stage
from tagledger.sinks.bronze import write_bronze
from tagledger.sources.pages import MAX_PAGES, CardRules, as_bronze, card_records, extract_cards

_PAGE = "_is_page"


@dataclass(frozen=True)
class Listings:
    """What was read of listings: their records, and the pages that were parsed with their numbers of records."""

    records: DataFrame
    pages: DataFrame


def _same(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])


def read_listings(
    pages: DataFrame, rules: CardRules, max_pages: int = MAX_PAGES, listing: Sequence[str] = ("category",)
) -> Listings:
    """Parse ``pages(category, page_num, scraped_at, html)`` the way listings are read: page by page.

    A round for each page number; a listing whose page gave no record takes no part in later
    rounds, so nothing behind that page is parsed.  A round writes its records, without the
    markup, and in the same pass a short row per page, so pages are counted without reading them again.
    """
    keys = list(dict.fromkeys([*listing, "category", "page_num", "scraped_at"]))
    rounds: list[DataFrame] = []
    counts: list[DataFrame] = []
    ended: list[DataFrame] = []
    for number in range(1, max_pages + 1):
        now = pages.filter(F.col("page_num") == number)
        if ended:
            gone = reduce(DataFrame.unionByName, ended)
            now = lookup_join(now, gone, _same(listing), "left_anti")
        cards = extract_cards(now, rules, keep=keys, marker=_PAGE)
        rows = stage(card_records(cards, keep=keys, marker=_PAGE), "records")
        per_page = rows.groupBy(*listing, "page_num").agg(F.count_if(~F.col(_PAGE)).alias("n_records"))
        empty = per_page.filter("n_records = 0")
        ended.append(stage(empty.select(*[F.col(c).alias(f"_{c}") for c in listing]), "ended"))
        rounds.append(rows.filter(~F.col(_PAGE)).drop(_PAGE))
        counts.append(per_page)
    return Listings(reduce(DataFrame.unionByName, rounds), reduce(DataFrame.unionByName, counts))


def pages_to_bronze(
    pages: DataFrame,
    rules: CardRules,
    source: str,
    max_pages: int = MAX_PAGES,
    listing: Sequence[str] = ("category",),
) -> DataFrame:
    """Bronze rows of ``pages(category, page_num, scraped_at, html)``: page by page, up to the first one without records."""
    return as_bronze(read_listings(pages, rules, max_pages, listing).records, source)


def land_pages(
    pages: DataFrame,
    rules: CardRules,
    source: str,
    root: str,
    slot: Slot | None = None,
    max_pages: int = MAX_PAGES,
    listing: Sequence[str] = ("category",),
) -> Slot:
    return write_bronze(pages_to_bronze(pages, rules, source, max_pages, listing), root, slot)
