"""Importance resampling against plain Python."""

import math
import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tagledger.llm import resampling

BUCKETS = 10_000


def grams(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(docs, target):
    """Rows as the report has them, and N."""

    def counts(texts):
        out = [0] * BUCKETS
        for text in texts:
            for g in grams(text)[1]:
                out[zlib.crc32(g.encode()) % BUCKETS] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + BUCKETS) / ((s[b] + 1) * (sum(t) + BUCKETS)))) for b in range(BUCKETS)
    ]
    rows = []
    for id_, text in docs:
        words, found = grams(text)
        weight = sum(gain[zlib.crc32(g.encode()) % BUCKETS] for g in found)
        h = int(sha256(f"42:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        rows.append([id_, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: 5 * len(able) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def test_report_against_plain_python(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    target = ["The quick brown fox, the quick brown fox.", None, rows[7][1], "Éa éB 1x"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(r) for r in resampling.resampling_report(docs, goal).collect()]
    assert sorted(got, key=str) == sorted(plain(rows, target), key=str)


def test_slices_and_pieces_change_nothing(monkeypatch):
    texts = pa.array(["a b c d e f g", "", None, "A", "x-y z1" * 30, "é è " * 50, "solo"])
    batch = pa.record_batch([texts], names=["text"])

    def total():
        out = []
        for piece in resampling._pieces(iter([batch])):
            words, owner = resampling.split_words(piece.column("text"))
            found = np.zeros(97, int)
            for _, at in resampling.feature_buckets(words, owner, 97, 3, resampling.SLICE_WORDS):
                found += np.bincount(at, minlength=97)
            out.append(found)
        return sum(out).tolist()

    whole = total()
    assert sum(whole) == sum(len(grams(t)[1]) for t in texts.to_pylist())
    for step, size in ((1, 1), (2, 40), (7, 1 << 20)):
        monkeypatch.setattr(resampling, "SLICE_WORDS", step)
        monkeypatch.setattr(resampling, "TEXT_BYTES", size)
        assert total() == whole


def test_draw_with_ties_and_copies(spark):
    rows = [(i, 25, 1, 10 * (i % 3), 7 if i < 300 else i % 5) for i in range(600)]
    df = spark.createDataFrame([*rows, (700, 3, 1, 0, 999), (5, 25, 1, 20, 7)], "doc_id long, n_words long, n_features long, weight long, score long")
    got = resampling.draw(df).collect()
    assert len(got) == 602
    able = sorted(((-r["score"], r["doc_id"]) for r in got if r["n_words"] >= 20))
    drawn = sorted((r["rank"], -r["score"], r["doc_id"]) for r in got if r["rank"])
    assert [d[1:] for d in drawn] == able[:30] and [d[0] for d in drawn] == list(range(1, 31))


def test_edges(spark):
    long = " ".join(f"w{i % 7}" for i in range(200_000))
    rows = [(1, None), (2, ""), (None, long), (3, "..."), (3, "..."), (4, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("s"), "bucket": F.lit(1), "rank": F.lit(0)})
    none = df.limit(0)
    got = {(r["doc_id"], r["n_features"], r["weight"]) for r in resampling.resampling_report(df, none).collect()}
    assert {(1, 0, 0), (2, 0, 0), (3, 0, 0)} <= got and {n for i, n, _ in got if i is None} == {3 * 200_000 - 3}
    assert resampling.resampling_report(df, df).count() == 6
    assert resampling.resampling_report(none, df).count() == 0
