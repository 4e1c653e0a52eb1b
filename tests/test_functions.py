from datetime import date

from pyspark.sql import functions as F

from tagledger.functions import calendar, identity, money, text
from tagledger.sources.spine import date_spine


def test_price_text(values):
    texts = ["₹97,999", " ₹1,05,375.27 ", "", None, "abc", "₹", "1e3", "12d", " ₹5 ", "-3"]
    assert values(money.parse_price, texts) == [97999.0, 105375.27, None, None, None, None, 1000.0, None, 5.0, -3.0]


def test_discount_text(values):
    texts = ["7%", " 7 % ", "", None, "7.5%", "0%", "100%", "-7%", "x", "99999999999%"]
    assert values(money.parse_discount, texts) == [7, 7, None, None, None, 0, 100, -7, None, None]


def test_rating_text(values):
    assert values(money.parse_rating, ["4.15", " 4 ", "", "new", None, "4.5f"]) == [4.15, 4.0, None, None, None, None]


def test_list_price(spark):
    rows = [(90.0, 10), (90.0, 0), (90.0, None), (90.0, 100), (90.0, 120), (None, 10), (0.0, 10), (99.0, -10)]
    df = spark.createDataFrame(rows, "price double, pct int")
    found = [r[0] for r in df.select(money.mrp_from_discount(F.col("price"), F.col("pct"))).collect()]
    assert found == [100.0, None, None, None, -450.0, None, None, 90.0]


def test_round2(values):
    assert values(money.round2, [1.234, 1.236, -1.234, None], "double") == [1.23, 1.24, -1.23, None]


def test_strip_and_trim(values):
    assert values(text.strip_text, ["\t a b 　\n", "", None]) == ["a b", "", None]
    assert values(text.trim_spaces, ["  a\t", "\ta  "]) == ["a\t", "\ta"]


def test_first_word(values):
    assert values(text.first_word, ["Apple iPhone 15", "", "Solo", " lead", None]) == ["Apple", "", "Solo", "", None]


def test_references(values):
    texts = ["a &amp; b", "&amp;lt;", "&#8377;5 &#x20B9;", "x&amp", "&nope; &", "&#38;lt;", "&lt;&gt;&quot;&apos;", None]
    want = ["a & b", "&lt;", "₹5 ₹", "x&", "&nope; &", "&lt;", "<>\"'", None]
    assert values(text.decode_references, texts) == want


def test_element_text(values):
    texts = [" Apple <b> 15 </b> Pro ", "<i>&#8377;</i> 9&nbsp;", "", "a <br title='x>y'> b", "1 < 2"]
    assert values(text.element_text, texts) == ["Apple15Pro", "₹9", "", "ab", "1 < 2"]


def test_hidden_markup(values):
    html = "a<!-- <p>x</p> -->b<script>var t='</p>';</script>c<STYLE>p{}</STYLE >d"
    assert values(text.drop_hidden, [html]) == ["abcd"]


def test_urls(values):
    found = values(lambda c: text.resolve_url("https://h", c), ["/x", "https://o/y", "z", "", None])
    assert found == ["https://h/x", "https://o/y", "z", "", ""]


def test_product_id_ignores_case_and_blanks(spark):
    rows = [(" Apple X ", "c"), ("apple x", "c"), ("apple x", "d"), ("a", None)]
    df = spark.createDataFrame(rows, "n string, c string")
    ids = [r[0] for r in df.select(identity.product_id(F.col("n"), F.col("c"))).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert ids[3] == "0cc175b9c0f1b6a831c399e269772661"  # md5 of 'a'


def test_calendar(spark):
    df = date_spine(spark).select(*calendar.calendar_columns(F.col("date_day")))
    rows = {r["full_date"]: r for r in df.collect()}
    assert len(rows) == 730 and min(rows) == date(2026, 1, 1) and max(rows) == date(2027, 12, 31)
    sunday, new_year = rows[date(2026, 1, 4)], rows[date(2027, 1, 1)]
    assert (sunday["date_key"], sunday["day_of_week"], sunday["week_number"], sunday["is_weekend"]) == (20260104, 0, 1, True)
    assert (sunday["day_name"], sunday["month_name"]) == ("Sunday   ", "January  ")
    assert (new_year["day_of_week"], new_year["week_number"], new_year["year"], new_year["is_weekend"]) == (5, 53, 2027, False)


def test_every_reference_of_the_standard_table(spark):
    from html.entities import html5

    rows = [(f"x &{name} y", f"x {value} y") for name, value in html5.items() if name.endswith(";")]
    rows += [(f"&{name}=", f"{value}=") for name, value in html5.items() if not name.endswith(";")]
    df = spark.createDataFrame(rows, "v string, want string").select("v", "want", text.decode_references(F.col("v")).alias("got"))
    assert df.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


def test_strip_takes_every_white_space(values):
    spaces = [c for c in map(chr, range(0x110000)) if c.isspace()]
    assert sorted(text.SPACES) == sorted(spaces)
    assert values(text.strip_text, [f"{c}a{c}b{c}" for c in spaces]) == [f"a{c}b" for c in spaces]


def test_references_of_each_kind(values):
    texts = ["a?b=1&amp;c&amp;d", "&amp;amp;", "&amp;&lt;x", "&#8377;5", "&#0008377 5", "&#x20B9;5", "&#0;", "&#99999999;", "&ampx", "&bogus;", "a&", "&#;", None]
    expected = ["a?b=1&c&d", "&amp;", "&<x", "₹5", "₹ 5", "₹5", "\ufffd", "\ufffd", "&x", "&bogus;", "a&", "&#;", None]
    assert values(text.decode_references, texts) == expected
    assert values(text.element_text, ["\u3000x \t", " é ", "<i>&#8377;</i> 5 ", " ", None]) == ["x", "é", "₹5", "", None]
