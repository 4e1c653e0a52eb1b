"""Spelling variants against all pairs."""

import random
import zlib
from collections import Counter

import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from tagledger.llm import spelling


def edits(a, b):
    """The whole edit matrix."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def by_all_pairs(counts, ratio=10):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and edits(w, v) == 1] for w in counts}
    top = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in top.items() if counts[v] >= ratio * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def words_one_edit_around(draw, alphabet, bases, size):
    out = Counter()
    for _ in range(bases):
        word = "".join(draw.choice(alphabet) for _ in range(draw.randint(*size)))
        out[word] += draw.choice([1, 30, 400])
        for _ in range(draw.randint(0, 14)):
            at, kind = draw.randrange(len(word) + 1), draw.randrange(3)
            changed = word[:at] + ("" if kind == 0 else draw.choice(alphabet)) + word[at + (kind < 2) :]
            out[changed] += draw.choice([1, 2, 12, 150])
            word = draw.choice([word, changed])
    return {w: n for w, n in out.items() if w}


def got_forms(spark, counts, **limits):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spelling.spelling_forms(df, **limits).collect()
    assert len(rows) == len(counts)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("seed,alphabet,size", [(1, "ab", (3, 9)), (2, "abcdéÿ", (7, 12)), (3, "aé𝒳", (1, 5))])
def test_forms_against_all_pairs(spark, seed, alphabet, size):
    counts = words_one_edit_around(random.Random(seed), alphabet, 40, size)
    want = by_all_pairs(counts)
    assert got_forms(spark, counts) == want
    # Groups that are dealt again, and chunks and searches of a few rows, change nothing.
    assert got_forms(spark, counts, rows=4, chunk=7, searches=3) == want
    assert got_forms(spark, counts, cells=9, chunk=1) == want


def test_chain_of_forms_and_ties(spark):
    counts = {"letters": 1000, "lettersx": 100, "lettersxy": 10, "lettersxyz": 1, "wordsaa": 1, "wordsab": 20, "wordsac": 20}
    got = got_forms(spark, counts)
    assert got["lettersxyz"][:2] == ("lettersxy", "letters") and got["letters"][:2] == (None, "letters")
    assert got["wordsaa"][0] == "wordsab" and got["wordsab"][3] == 2


def test_very_long_words(spark):
    long = "ab" * 30_000
    counts = {long: 50, long + "c": 1, "x" + long: 2, long[:-1] + "d": 3, long[:30_000] + "q" + long[30_001:]: 4}
    assert got_forms(spark, counts, cells=1000) == got_forms(spark, counts)
    assert {w: f[0] for w, f in got_forms(spark, counts).items() if w != long} == dict.fromkeys([w for w in counts if w != long], long)


def test_report_against_plain_python(spark, docs):
    seen = Counter()
    for r in docs.collect():
        for run in regex.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = regex.sub("[A-Z]", lambda m: m[0].lower(), run)
            code = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            if code % 31 == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            seen[run] += 1
    counts = {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}
    rows = spelling.spelling_report(docs).collect()
    near = {w: set() for w in counts}
    for w in counts:
        for i in range(len(w)):
            if w[:i] + w[i + 1 :] in counts:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    holes = {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
    for group in holes.values():
        for w in group:
            near[w].update(v for v in group if v != w)
    assert {r["word"]: (r["n"], r["n_near"]) for r in rows} == {w: (n, len(near[w])) for w, n in counts.items()}


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "Éclaires ÉCLAIRES Éclaires"), (3, "1234567 abc-defghij"), (3, "1234567 abc-defghij"), (4, "éclaires")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("w"), "n": F.lit(1), "key": F.lit("k")})
    got = {r["word"]: r["n"] for r in spelling.spelling_report(df).collect()}
    # Only A-Z is lower-cased, and rows that repeat count each.
    assert set(got) <= {"Éclaires", "ÉclaireÉ", "defghij", "claires", "éclaires"} and got.get("defghij", 2) == 2
    assert spelling.spelling_report(df.limit(0)).count() == 0
    assert spelling.spelling_report(df.filter("doc_id = 1")).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    nothing = pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    assert spelling.spelling_forms(spark.createDataFrame(nothing.to_pandas(), "word string, n long")).count() == 0
