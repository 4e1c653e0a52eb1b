import pytest
from pyspark.sql import functions as F

from tagledger.functions.markup import (
    TagRule,
    cut_at_tags,
    element_here,
    first_element,
    from_first,
    near_element,
    plain_element,
    starts_with_tag,
    whole_element,
)
from tagledger.plans.pages import pages_to_bronze, read_listings
from tagledger.sources.pages import CardRules, card_records, cut_pages, extract_cards

RULES = CardRules(base_url="https://h")


def card(name="<a class='name' href='/p/1'>Phone A</a>", price="<span class='price'>₹1,000</span>", more=""):
    return f"<div class='sm-product has-x'><div class='img'></div>{name}{price}{more}</div>"


def records(spark, html):
    pages = spark.createDataFrame([(html,)], "html string")
    return [r.asDict() for r in card_records(extract_cards(pages, RULES)).collect()]


def test_full_card(spark):
    more = "<span class='sm-pdrop'> 7% </span><div><div><span class='sm-rating'><b>4.15</b></span></div></div>"
    (found,) = records(spark, f"<html>{card(more=more)}</html>")
    assert found == {
        "product_name": "Phone A",
        "product_url": "https://h/p/1",
        "current_price": 1000.0,
        "mrp": 1075.27,
        "discount_pct": 7,
        "rating": 4.15,
    }


def test_fields_belong_to_their_card(spark):
    html = card() + "<div class='ad'><span class='sm-pdrop'>50%</span></div>" + card(
        "<a class='name' href='https://o/2'>Phone B</a>", "<span class='price'>2</span>"
    ) + "<span class='sm-rating'>1</span>"
    a, b = records(spark, html)
    assert (a["product_name"], a["discount_pct"], a["rating"]) == ("Phone A", None, None)
    assert (b["product_url"], b["rating"]) == ("https://o/2", None)


def test_first_of_each_field(spark):
    (found,) = records(spark, card(more="<span class='price'>9</span><a class='name' href='/z'>Z</a>"))
    assert (found["current_price"], found["product_name"]) == (1000.0, "Phone A")


def test_nested_field_is_not_cut(spark):
    (found,) = records(spark, card(price="<span class='price'><span>₹</span><span>97,</span>999</span>"))
    assert found["current_price"] == 97999.0


@pytest.mark.parametrize(
    "html",
    [
        "",
        "<p>nothing</p>",
        "<!-- " + card() + " -->",
        "<script>'" + card() + "'</script>",
        card(name=""),
        card(name="<a class='other' href='/x'>X</a>"),
        card(name="<a class='name' href='/x'> </a>"),
        card(price=""),
        card(price="<span class='price'>soon</span>"),
        card(price="<span class='price'>₹0</span>"),
        card(price="<span class='old-price'>5</span>"),
        "<div class='sm-products'>" + card()[len("<div class='sm-product has-x'>"):],
    ],
)
def test_incomplete_cards_are_dropped(spark, html):
    assert records(spark, html) == []


def test_card_without_name_text_is_a_card_but_no_record(spark):
    pages = spark.createDataFrame([(card(name="<a class='name'></a>"),)], "html string")
    (found,) = extract_cards(pages, RULES).collect()
    assert (found["product_name"], found["product_url"]) == ("", "")


@pytest.mark.parametrize(
    ("tag", "matches"),
    [
        ('<div class="sm-product">', True),
        ("<DIV id=x CLASS='a sm-product b'>", True),
        ("<div class=sm-product>", True),
        ('<div title="a > b" class="sm-product">', True),
        ('<div data-class="sm-product">', False),
        ("<div title=\" class='sm-product' \">", False),
        ('<div class="sm-product-x">', False),
        ('<divx class="sm-product">', False),
    ],
)
def test_class_by_token(spark, tag, matches):
    df = spark.createDataFrame([(tag,)], "t string")
    assert df.select(starts_with_tag(F.col("t"), RULES.card)).first()[0] is matches


def test_class_by_part(spark):
    df = spark.createDataFrame([('<a class="x product-name">',), ("<a class=myname>",), ("<a class='nam'>",)], "t string")
    rule = TagRule("a", "name", "part")
    assert [r[0] for r in df.select(starts_with_tag(F.col("t"), rule)).collect()] == [True, True, False]


def test_unclosed_card_and_large_page(spark):
    filler = "<p>" + "x" * 500_000 + "</p>"
    html = filler + card()[: -len("</div>")] + filler
    assert len(records(spark, html)) == 1


def test_page_cut(spark):
    rows = [("a", 1, 3), ("a", 2, 0), ("a", 3, 5), ("b", 1, 0), ("b", 2, 9), ("c", 1, 1), ("c", 2, 1), ("c", 3, 1), (None, 1, 2)]
    pages = spark.createDataFrame(rows, "category string, page_num int, n_records bigint")
    found = {(r[0], r[1]) for r in cut_pages(pages).collect()}
    assert found == {("a", 1), ("c", 1), ("c", 2), (None, 1)}


def test_pages_to_bronze(spark):
    sold = "<p>sold out</p>"
    rows = [("x", 1, card()), ("x", 2, card() + card()), ("x", 3, card()), ("y", 1, sold), ("y", 2, card()), ("z", 1, card(price=""))]
    pages = spark.createDataFrame([(c, n, "2026-08-04T06:00:00", h) for c, n, h in rows], "category string, page_num int, scraped_at string, html string")
    found = pages_to_bronze(pages, RULES, "shop")
    assert [r["category"] for r in found.collect()] == ["x"] * 3
    assert found.first()["source"] == "shop"


def test_nothing_behind_an_empty_page_is_parsed(spark):
    sold = "<p>sold out</p>"
    rows = [("x", n, card()) for n in (1, 2, 3, 4, 5)] + [("y", 1, card()), ("y", 2, sold), ("y", 3, card()), ("z", 1, None), ("z", 2, card())]
    rows += [("gap", 1, card()), ("gap", 3, card() + card()), (None, 1, card()), (None, 2, "")]
    pages = spark.createDataFrame([(c, n, "2026-08-04T06:00:00", h) for c, n, h in rows], "category string, page_num int, scraped_at string, html string")
    read = read_listings(pages, RULES, max_pages=4)
    parsed = {(r["category"], r["page_num"]): r["n_records"] for r in read.pages.collect()}
    assert parsed == {
        ("x", 1): 1, ("x", 2): 1, ("x", 3): 1, ("x", 4): 1, ("y", 1): 1, ("y", 2): 0, ("z", 1): 0,
        ("gap", 1): 1, ("gap", 3): 2, (None, 1): 1, (None, 2): 0,
    }
    assert read.records.count() == sum(parsed.values())


def test_elements_in_one_pass_are_those_found_by_counting(spark):
    texts = [
        card(),
        "<div><div>a</div><div>b</div></div>c",
        "<div><div><div>a</div></div></div>b",
        "<div><div>never closed</div>",
        "<div><span class='price'>1</span >",
        "<div><span class='price'><span>1</span></span>2",
        "<div><span class='price'>1</spanx",
        "<div><span class='price' title='</span>'>1</span>",
        "<div><b title=\"<span class='price'>\">1</span>",
        "<div><span class='x price y' id=1\n>1</SPAN\t></div>",
        "<div><span>1</span>",
        "<div>",
        None,
    ]
    near, plain = near_element(F.col("t"), RULES.price), plain_element(F.col("t"), "div")
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", near.alias("near"), plain.alias("plain"))
    counted = first_element(cut_at_tags(from_first(F.col("t"), RULES.price), "span"))
    found = df.select(
        whole_element(F.col("near"), F.col("t"), RULES.price).alias("element"),
        counted.alias("element_counted"),
        element_here(F.col("plain"), F.col("t"), "div").alias("card"),
        first_element(cut_at_tags(F.col("t"), "div")).alias("card_counted"),
        "plain",
    ).collect()
    assert [r["element"] for r in found] == [r["element_counted"] for r in found]
    assert [r["card"] for r in found] == [r["card_counted"] for r in found]
    assert [r["plain"] != "" for r in found[:4]] == [True, True, False, False]


def test_rows_without_a_card_are_dropped_without_copying_the_others(spark):
    pages = spark.createDataFrame([(card(),)], "html string")
    plan = card_records(extract_cards(pages, RULES))._jdf.queryExecution().optimizedPlan().toString()
    assert "inline(" not in plan and "size(" not in plan
