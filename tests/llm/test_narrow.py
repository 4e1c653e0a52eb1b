"""Operators that look at one row at a time: tokens, licenses, languages, quality, pages."""

import random
import time
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import TABLES, differences
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagledger.llm import bpe, langid, licenses, quality
from tagledger.llm.html_text import extract_text, page_text
from tagledger.llm.suite import ORACLES, QUERIES, TOKENIZER
from tagledger.llm.tables import table
from tagledger.llm.vocabulary import Vocabulary

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    with open(TOKENIZER, encoding="utf-8") as file:
        return Vocabulary.parse(file.read())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    assert differences(QUERIES[name](spark, SMALL), connection, ORACLES[name]) == []


def test_tokens_equal_the_library(vocabulary):
    draw = random.Random(3)
    odd = [chr(c) for c in [*range(32, 127), *range(0xA0, 0x180), 0x3A3, 0x300, 0x301, 0x1C, 0x85, 0x2028, 0x130, 0x212A, 0x4E00, 0x1F600, 0x558]]
    texts = ["", " ", "a" * 500, "<|endoftext|> x<|startoftext|>", "It's WE'LL 'd", "ΑΣ Σ"]
    for _ in range(1500):
        texts.append("".join(draw.choice(odd) for _ in range(draw.randint(0, 40))))
        texts.append("".join(draw.choice(["the", "ing", "er", "tion", " ", "aa", "!!"]) for _ in range(draw.randint(1, 30))))
    for text in texts:
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        got = vocabulary.encode(text)
        assert got.tolist() == want, text
        assert vocabulary.decode(got) == LIBRARY.decode(want, skip_special_tokens=False), text


def test_full_caches_change_nothing(vocabulary):
    text = "one two three four five six seven one two"
    want = vocabulary.encode(text).tolist()
    vocabulary.cache_size, vocabulary.cached, vocabulary.fitting = 3, {}, {}
    assert vocabulary.encode(text).tolist() == want
    vocabulary.cache_size = 400_000


def test_token_digests(spark):
    rows = [(1, None), (2, ""), (3, "Hello  World"), (3, "Hello  World"), (None, "x " * 50_000)]
    got = bpe.digests(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER).collect()
    assert len(got) == 5
    for row, (_, text) in zip(got, rows):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a b", "old")], "id int, text string, token_ids string")
    back = bpe.decode(bpe.encode(df, TOKENIZER), TOKENIZER).first()
    assert back["id"] == 1 and back["decoded"] == "a</w> b</w>"
    assert bpe.encode(df.limit(0), TOKENIZER).count() == 0


def test_license_priority_and_containment(spark):
    texts = [
        None,
        "",
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: MIT License",
        "cc by cc by",
        "GNU Lesser General Public License v3; General Public License",
        "x " * 100_000 + "All Rights Reserved",
        "unlicensed apache helicopters",
    ]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id int, text string, score int")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    assert [got[i]["detections"] for i in range(8)] == [
        [], [], ["apache-2.0"], ["mit"], ["cc-by", "cc-by"], ["lgpl-3.0", "gpl"], ["reserved"], []
    ]
    assert (got[4]["n_base"], got[4]["first_word"], got[4]["last_word"]) == (2, 0, 2)
    assert (got[6]["first_word"], got[6]["n_words"]) == (100_000, 100_003)
    # The longer name is one detection, and the phrase inside it is still counted.
    assert (got[5]["n_base"], got[5]["base_labels"], got[5]["labels"]) == (2, "gpl", "gpl,lgpl-3.0")
    assert got[0]["first_word"] is None and got[0]["score"] == 0.0 and got[3]["score"] == 1.0


def test_license_query_is_native(spark):
    plan = QUERIES["op2_licenses"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def _held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    got = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count() and all(r["held_out"] == _held_out(r["doc_id"]) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark, docs):
    model = langid.train(docs)
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, "the " * 200_000)]
    got = langid.identify(spark.createDataFrame(rows, "score int, text string"), model).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "en"]
    assert langid.train(docs.limit(0)) == {"languages": []}
    assert {r["lang_pred"] for r in langid.language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.train(docs, labels)
    scored = quality.score_quality(docs.join(labels, "doc_id").filter("crc32(cast(doc_id as string)) % 3 = 1"), model)
    got = scored.select("quality", "score").collect()
    right = [(r["score"] >= 0.5) == (r["quality"] == 1) for r in got]
    assert sum(right) / len(right) > 0.98


def test_quality_edges(spark, docs):
    labels = table(spark, SMALL, "labels")
    rows = [(1, None), (2, ""), (None, "a b"), (3, "ok " * 100_000)]
    model = quality.train(docs, labels)
    got = quality.score_quality(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert all(0 <= r["score"] <= 1 for r in got) and got[0]["score"] == got[1]["score"] >= 0.5
    assert {r["predicted"] for r in quality.quality_report(docs, labels.limit(0)).collect()} == {1}
    # Slices give the features of the whole.
    text = "".join(random.Random(1).choice("ab cd") for _ in range(5_000))
    whole = sorted(np.concatenate(list(quality.features(text))).tolist())
    before, quality._SLICE = quality._SLICE, 700
    assert sorted(np.concatenate(list(quality.features(text))).tolist()) == whole
    quality._SLICE = before


PAGES = [
    (None, ""),
    ("", ""),
    ("<p>a<p>b", "a\n\nb"),
    ("<ul><li>a<li>b<ol start=3><li>x</ol></ul>", "- a\n- b\n\n  3. x"),
    ("<table><tr><th>Name<th>N<tr><td>apple<td>3</table>", "Name   N\napple  3"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("x<div hidden>no</div><span style='display: none'>no</span><script>no</script>y", "xy"),
    ("a &lt; b &eacute; < c", "a < b é < c"),
    ("<pre>  x\n   y</pre>", "  x\n   y"),
    ("a<br>b<!-- c", "a\nb"),
    ("</p></div>t</td>", "t"),
    ("<head><title>T</title>shown", "shown"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_page(page, text):
    assert page_text(page) == text


def test_hard_pages(spark):
    pages = ["<div>" * 5_000 + "x", "<a " + "b=c " * 100_000 + ">y", '<a href="' * 5_000, "<" * 50_000, "<table>" * 3_000 + "z"]
    df = spark.createDataFrame([(i, p, "old") for i, p in enumerate(pages)], "page_id int, html string, text string")
    got = {r["page_id"]: r["text"] for r in extract_text(df).collect()}
    assert got[0] == "x" and got[1] == "y" and got[4] == "z" and got[3] == "<" * 50_000
    assert extract_text(df.limit(0)).count() == 0


def test_hidden_text_stays_hidden_at_any_depth():
    for depth in (10, 149, 150, 151, 400):
        deep, end = "<div>" * depth, "</div>" * depth
        assert page_text(f"<div hidden>{deep}no{end}</div><p>yes") == "yes"
        assert page_text(f"{deep}<div hidden>no<div>no</div>no</div>yes{end}<p>more").split() == ["yes", "more"]
        lines = page_text(f"{deep}a<div>b</div>c<b>d</b>{end}e").split("\n")
        assert [x for x in lines if x] == ["a", "b", "cd", "e"]


def test_columns_stay_in_line_behind_wide_cells():
    rows = f"<tr><td>{'x' * 70}<td>b<td>c<tr><td>a<td>{'y' * 61} z<td>c2<tr><td>a<td>b<td>d"
    assert page_text(f"<table>{rows}</table>").split("\n") == [
        "x" * 70, " " * 62 + "b" + " " * 61 + "c", "a" + " " * 61 + "y" * 61 + " z", " " * 124 + "c2", "a" + " " * 61 + "b" + " " * 61 + "d"
    ]


def test_large_tables_and_deep_pages_take_linear_time():
    pages = {
        "<table><tr>" + "<td>x" * 8_000 + "<tr><td>y" * 8_000 + "</table>": 16_000,
        "<table><tr>" + "<td rowspan=65534>x" * 4_000 + "<tr><td>y" * 4_000 + "</table>": 8_000,
        "<div>" * 50_000 + "x" + "</div>" * 50_000: 1,
        "<table><tr><td>" + "z" * 100_000 + "<td>q" + "<tr><td>a<td>b" * 20_000 + "</table>": 140_001,
    }
    for page, letters in pages.items():
        start = time.perf_counter()
        assert sum(map(str.isalpha, page_text(page))) == letters
        assert time.perf_counter() - start < 8


def test_language_against_plain_naive_bayes(spark, docs):
    """Log-probabilities added up n-gram by n-gram, over the same buckets."""
    model = langid.train(docs)
    texts = [r["text"] for r in docs.limit(40).collect()] + [None, "", "123 ...", "é", "the of and"]
    names, scores = langid.predict_all(texts, model)
    for text, name, score in zip(texts, names, scores):
        total, some = model["prior"].copy(), False
        for at in langid.grams(text) if text else ():
            for bucket in at.tolist():
                total, some = total + model["matrix"][bucket], True
        odds = np.exp(total - total.max())
        want = (model["languages"][int(total.argmax())], 1 / odds.sum()) if some else ("und", 0.0)
        assert name == want[0] and abs(score - want[1]) < 1e-6
    counts = np.zeros((1 << langid.HASH_BITS, len(model["languages"])))
    for r in docs.collect():
        if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1:
            for at in langid.grams(r["text"] or ""):
                np.add.at(counts[:, model["languages"].index(r["lang"])], at, 1)
    chance = (counts + langid.SMOOTHING) / (counts + langid.SMOOTHING).sum(axis=0)
    assert np.abs(np.log(chance) - model["matrix"]).max() < 1e-4
    assert langid.train(docs, most=2)["languages"] == sorted(langid.train(docs, most=2)["languages"])
    assert len(langid.train(docs, most=2)["languages"]) == 2


def test_language_edges(spark, docs):
    none = docs.limit(0)
    assert langid.language_report(none).count() == 0
    blank = docs.limit(3).withColumns({"lang": F.lit(None).cast("string"), "_parts": F.lit(1), "_lang": F.lit("x")})
    assert {r["lang_pred"] for r in langid.language_report(blank).collect()} == {"und"}


LICENSE_NOTICES = {
    "SPDX-License-Identifier: MIT": "mit",
    "// SPDX-License-Identifier: MPL-2.0": "mpl-2.0",
    "SPDX-License-Identifier: ISC": "isc",
    "SPDX-License-Identifier: EPL-2.0": "epl-2.0",
    "SPDX-License-Identifier: Zlib": "zlib",
    "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
    "SPDX-License-Identifier: GPL-3.0-only": "gpl-3.0",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "This code is released under GPL.": "gpl",
    "licensed under the MIT": "mit",
    "Licensed under the Apache License, Version 2.0 (the License)": "apache-2.0",
    "available under the terms of the MIT license": "mit",
    "distributed under the Boost Software License, Version 1.0": "boost-1.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    "This work is licensed under CC BY-SA 4.0": "cc-by,cc-by-sa",
    "not licensed under the MIT License": "denied",
    "It is not released under the GNU General Public License": "denied,gpl",
    "komm mit uns unter den Baum": "",
    "he went under the bridge with apache helicopters": "",
    "the vim editor and the curl tool, used under load": "",
    "an artistic work in the public eye": "",
}


def test_hand_labelled_notices(spark):
    df = spark.createDataFrame(list(enumerate(LICENSE_NOTICES)), "doc_id int, text string").withColumn("labels", F.lit("old"))
    got = {r["text"]: r["labels"] for r in licenses.scan_licenses(df).collect()}
    assert got == LICENSE_NOTICES
    assert len(licenses.ordered_rules()) > 400
    assert licenses.scan_licenses(df.limit(0)).count() == 0
