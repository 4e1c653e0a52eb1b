"""Inputs that once lost rows, stopped a job or gave a wrong number."""

import json
import math

import pytest
from pyspark.sql import functions as F

from tagledger.functions.markup import TagRule, attribute, starts_with_tag
from tagledger.functions.money import mrp_from_discount
from tagledger.functions.text import decode_references, drop_hidden
from tagledger.schemas import BRONZE, Slot
from tagledger.sinks.bronze import write_bronze
from tagledger.sources.bronze import read_bronze

SLOT = Slot.parse("2024-01-01", "06")


def bronze_rows(n):
    return [{f.name: f"{f.name} {i}" for f in BRONZE.fields} for i in range(n)]


def test_written_bronze_comes_back_by_default(spark, tmp_path):
    rows = bronze_rows(500)
    df = spark.createDataFrame([[r[f.name] for f in BRONZE.fields] for r in rows], BRONZE).withColumn("category", F.lit("c"))
    write_bronze(df.withColumn("source", F.lit("shop")), str(tmp_path), SLOT)
    assert read_bronze(spark, str(tmp_path), "shop", SLOT).count() == 500


def test_every_form_of_file_is_read_whole(spark, tmp_path):
    folder = tmp_path / "source=shop" / "category=c" / SLOT.folder
    folder.mkdir(parents=True)
    rows = bronze_rows(6)
    (folder / "pretty.json").write_text(json.dumps(rows, indent=2))
    (folder / "one line.json").write_text(json.dumps(rows))
    (folder / "lines.json").write_text("\n\n" + "\n".join(map(json.dumps, rows)))
    (folder / "arrays.json").write_text("\n".join(json.dumps(rows[i : i + 2]) for i in (0, 2, 4)))
    (folder / "empty.json").write_text("")
    got = read_bronze(spark, str(tmp_path), "shop", SLOT)
    assert got.count() == 24 and got.filter("product_name is null").count() == 0


@pytest.mark.parametrize(
    "tag,link",
    [
        ("<a " + "b=c " * 200_000 + 'class="x y" href="/q">t</a>', "/q"),
        ("<a " + "z" * 1_000_000 + " class=x href=/r>", "/r"),
        ("<a " + "b='c' " * 200_000 + "class=x>", ""),
    ],
)
def test_long_start_tag(spark, tag, link):
    df = spark.createDataFrame([(tag,)], "v string")
    row = df.select(starts_with_tag(F.col("v"), TagRule("a", "x")).alias("s"), attribute(F.col("v"), "href").alias("h")).first()
    assert (row["s"], row["h"]) == (True, link)


def test_references(values):
    texts = ["&Uuml;&laquo;", "&amp;amp;", "&notit", "&bogus;", "&#9999999;", "&#1114112;", "&#xD800;", "&#00000038; &#x0000026;", "&#0;", "&eacute &euro &euro;"]
    want = ["Ü«", "&amp;", "¬it", "&bogus;", "�", "�", "�", "& &", "�", "é &euro €"]
    assert values(decode_references, texts) == want


def test_unclosed_comment(values):
    assert values(drop_hidden, ["n <!-- c</a>", "a<!-- x -->b"]) == ["n ", "ab"]


def test_rounding_at_the_edges(values):
    got = values(lambda v: mrp_from_discount(v, F.lit(7)), [math.nan, math.inf, 1e17, 93.0], "double")
    assert math.isnan(got[0]) and got[1] == math.inf and got[2] == 1e17 / (1 - 7 / 100) and got[3] == 100.0
