"""Operators over whole tables: mixing, fingerprints, near-duplicates, passages, the pipeline."""

import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagledger.llm import embedding_dedup, fingerprints, mixing, paragraph_dedup, simhash
from tagledger.llm.components import components
from tagledger.llm.suite import QUERIES
from tagledger.llm.tables import table

SMALL = "/root/testdata/sf0.001"


def union(nodes, pairs):
    """Brute force: the smallest member of each node's component."""
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(draw.randint(100, 160), draw.randint(100, 160)) for _ in range(40)]
    pairs += [(500, n) for n in range(501, 530)] + [(None, 3), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    clean = [p for p in pairs if None not in p]
    want = union({n for p in clean for n in p}, clean)
    assert all(got.get(n, n) == r for n, r in want.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mix_reaches_targets(spark, docs):
    got = mixing.mixing_report(docs).collect()
    by = defaultdict(list)
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by[r["source_size"], r["target"]].append(r)
    for (_, target), rows in by.items():
        assert abs(sum(r["taken"] for r in rows) - target) <= max(r["size"] for r in rows)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixing_report(docs.repartition(5)).collect()))


def test_mix_edges(spark):
    rows = [(1, None, None), (2, "", None), (None, "a b", None), (None, "a b", None), (4, "c d e", "x"), (5, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("old"))
    got = mixing.mix(df)
    assert {(r["size"], r["source_size"], r["target"]) for r in got.collect()} >= {(2, 4, 4.0), (3, 4, 8.0), (0, 4, 4.0)}
    assert sum(r["taken"] for r in got.collect()) == 12
    assert mixing.mixed_documents(df).columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0


def test_fingerprints_against_plain_python(spark, docs):
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_neighbours(docs).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert len(got) == len(rows)
    for i, (id_, text) in enumerate(rows):
        behind = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + behind[:half]
        own = fingerprints.sketch(text)
        assert got[id_]["edited_sha256"] == sha256(edited.encode()).hexdigest()
        assert got[id_]["fingerprint"] == fingerprints.shown(own)
        assert got[id_]["near_edited"] == fingerprints.likeness(own, fingerprints.sketch(edited))
        assert got[id_]["near_next"] == fingerprints.likeness(own, fingerprints.sketch(behind))


def test_fingerprint_estimates():
    draw = random.Random(4)
    book = [str(draw.random()) for _ in range(20_000)]
    page = book[3_000:4_000]
    small, large = fingerprints.sketch(" ".join(page)), fingerprints.sketch(" ".join(book))
    assert fingerprints.containment(small, large) == 1.0
    assert abs(fingerprints.containment(large, small) - 0.05) < 0.02
    other = fingerprints.sketch(" ".join(book[:10_000]))
    assert fingerprints.merge(small, other).tolist() == np.union1d(small, other).tolist()


def test_fingerprint_edges(spark):
    rows = [(None, "a b c"), (None, "a b c"), (None, None), (1, ""), (2, "x y z w v u"), (2, "x y z w v u"), (7, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert fingerprints.fingerprint_neighbours(df).count() == 7
    assert fingerprints.fingerprint_neighbours(df.limit(0)).count() == 0
    assert fingerprints.fingerprint(df.withColumn("fingerprint", F.lit(1))).filter("fingerprint = ''").count() == 2


def test_simhash_against_all_pairs(spark, docs):
    got = simhash.simhash_report(docs).collect()
    bits = {r["doc_id"]: simhash.text_fingerprint(r["text"]) for r in docs.collect()}
    ids = sorted(bits)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (bits[a] ^ bits[b]).bit_count() <= 4]
    want = union(ids, pairs)
    assert all(r["component_id"] == want[r["doc_id"]] and int(r["fingerprint"], 16) == bits[r["doc_id"]] for r in got)


def test_simhash_fingerprint_equals_spark(spark, docs):
    words = F.split(F.trim(F.regexp_replace(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x20\x09-\x0D]+", " ")), " ")
    rows = docs.select("text", words.alias("w")).selectExpr(
        "text", "transform(sequence(1, greatest(1, size(w) - 3)), i -> xxhash64(array_join(slice(w, i, 4), ' '))) as h"
    )
    for r in rows.limit(60).collect():
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r["h"]) > len(r["h"]))
        assert simhash.text_fingerprint(r["text"]) == want


def test_simhash_large_groups_are_dealt_again(spark):
    draw = random.Random(6)
    bits = set()
    for _ in range(3):
        base = draw.getrandbits(64)
        for _ in range(300):
            value = base
            for _ in range(draw.randint(0, 12)):
                value ^= 1 << draw.randrange(64)
            bits.add(simhash._signed(value))
    df = spark.createDataFrame([(b,) for b in bits], "bits long")
    got = {r["node"]: r["root"] for r in components(simhash.links(df, 4, group_rows=100)).collect()}
    whole = {b: b & 2**64 - 1 for b in bits}
    ids = sorted(bits)
    want = union(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (whole[a] ^ whole[b]).bit_count() <= 4])
    assert all(got.get(b, b) == r for b, r in want.items())


def test_simhash_edges(spark):
    rows = [(3, None), (2, ""), (None, ""), (5, "a b c d"), (5, "a b c d"), (6, "A  B c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bits", F.lit(1))
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash.simhash_report(df).collect())
    assert got == [(0, 2), (2, 2), (3, 2), (5, 5), (5, 5), (6, 5)]
    assert simhash.without_near_duplicates(df).columns == df.columns
    assert simhash.simhash_report(df.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    """Ids that occur with several texts, rows without an id, and rows that repeat."""
    x, y, z = ("a b c d e f", "q r s t u v w", "only one of its kind")
    rows = [(1, x), (2, x), (2, y), (None, x), (None, x), (None, z), (None, z), (3, y), (7, ""), (5, None), (4, "ü"), (4, "ü")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"tie": F.lit(0), "bits": F.lit("b")})
    out = simhash.without_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in out.collect()))) == sorted(
        map(str, [(1, x), (2, y), (None, z), (5, None), (4, "ü")])
    )


def test_vectors_against_all_pairs(spark):
    draw = np.random.default_rng(5)
    base = draw.standard_normal((40, 16))
    vectors = np.concatenate([base, *[base[:8] + 0.05 * draw.standard_normal((8, 16)) for _ in range(12)], base[:5]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.95) & ~np.eye(len(unit), dtype=bool)
    want = union(range(len(unit)), np.argwhere(near).tolist())
    assert all(got[i]["component_id"] == r and got[i]["kept"] == (i == r) for i, r in want.items())
    assert [got[i]["n_links"] for i in range(len(unit))] == near.sum(axis=1).tolist()
    # Groups larger than a window, and components in several parts, keep all their links.
    few = embedding_dedup.near_duplicate_vectors(df, window=3, block=8, members=5).collect()
    assert {r["vec_id"]: r["n_links"] for r in few} == dict(enumerate(near.sum(axis=1).tolist()))


def test_links_of_a_large_group_and_of_pairs_at_the_threshold(spark):
    draw = np.random.default_rng(9)
    base, far = draw.standard_normal(32), draw.standard_normal((600, 32))
    group = base + 0.16 * draw.standard_normal((700, 32))
    # Each pair at a cosine of 0.952.
    away = draw.standard_normal((600, 32))
    away -= (away * far).sum(axis=1, keepdims=True) / (far * far).sum(axis=1, keepdims=True) * far
    away *= np.linalg.norm(far, axis=1, keepdims=True) / np.linalg.norm(away, axis=1, keepdims=True)
    vectors = np.concatenate([group, far, 0.952 * far + (1 - 0.952**2) ** 0.5 * away])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicate_vectors(df, window=64, block=512).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = ((unit @ unit.T >= 0.95) & ~np.eye(len(unit), dtype=bool)).sum(axis=1)
    assert near[:700].min() > 64 and [got[i] for i in range(700)] == near[:700].tolist()
    assert sum(got[i] for i in range(700, 1900)) >= 0.99 * near[700:].sum()


def test_passes_follow_the_number_of_vectors():
    few, many = (embedding_dedup.passes_for(n) for n in (10_000, 10**8))
    assert 8 <= few <= 12 and 40 <= many <= 60 and embedding_dedup.passes_for(0) == 2


def test_vector_edges(spark):
    nan = float("nan")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [2.0, 4.0])]
    rows += [(7, [2.0, 4.0]), (None, [1.0, 2.0]), (8, [1.0, 2.0, 0.0]), (9, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicate_vectors(df).collect()]
    assert sorted((x for x in got if x[0]), key=lambda x: x[0]) == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 2, 5), (6, 2, 5), (7, 2, 5), (7, 2, 5), (8, 0, 8), (9, 0, 9)
    ]
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def planted():
    """Documents with passages at the end, between and inside lines, an edited line, and odd rows."""
    draw = random.Random(5)

    def sentence(n):
        words = ("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(n))
        return " ".join(words).capitalize() + "."

    def lines():
        return [" ".join(sentence(draw.randint(5, 14)) for _ in range(draw.randint(1, 6))) for _ in range(draw.randint(1, 6))]

    passages = [" ".join(sentence(n) for n in (12, 9, 16, 17)) for _ in range(3)]
    docs = [lines() for _ in range(200)]
    holders = set()
    for k, passage in enumerate(passages):
        for j in range(6):
            own = docs[20 * k + 3 * j]
            holders.add(20 * k + 3 * j)
            if j % 3 == 0:
                own[-1] += " " + passage
            elif j % 3 == 1:
                own.insert(1, passage)
            else:
                own[0] += " " + passage + " " + sentence(7)
    words = " ".join(sentence(11) for _ in range(7)).split()
    docs[150].append(" ".join(words))
    docs[151].append(" ".join([*words[:30], "zzz", *words[31:]]))
    rows = [(i, "\n".join(t)) for i, t in enumerate(docs)] + [(1000, None), (1001, ""), (None, passages[0])]
    return rows, passages, holders | {150, 151, None}


def test_passages_are_found_and_clean_documents_left(spark, planted):
    rows, passages, holders = planted
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in paragraph_dedup.passage_report(df).collect()} == holders
    out = paragraph_dedup.without_repeats(df.withColumn("n_chars", F.length("text").cast("long")))
    after = {r["doc_id"]: r for r in out.collect()}
    assert len(after) == len(rows)
    for passage in passages:
        assert sum(passage in (r["text"] or "") for r in after.values()) == 1
    before = dict(rows)
    assert all(after[i]["text"] == t for i, t in before.items() if i not in holders)
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in after.values())


def test_crowded_bands_lose_no_link(spark):
    draw = random.Random(8)
    base = [draw.randrange(2**31) for _ in range(60)]
    sets = [np.unique(np.array(base[:55] + [draw.randrange(2**31) for _ in range(5)], np.uint32)) for _ in range(80)]
    units = [paragraph_dedup.unit(0, 0, 1, 60, s) for s in sets]
    hashed = paragraph_dedup.bands(sets, [0] * 80)
    rows = [(u["digest"], b.tolist(), s.view(np.int32).tolist()) for u, b, s in zip(units, hashed, sets)]
    df = spark.createDataFrame(rows, "digest long, bands array<long>, elements array<int>")
    ids = [u["digest"] for u in units]
    pairs = [(ids[i], ids[j]) for i in range(80) for j in range(i) if paragraph_dedup.jaccard(sets[i], sets[j]) >= 0.8]
    for part in (1_000, 7):
        got = {r["node"]: r["root"] for r in components(paragraph_dedup.similar(df, 0.8, part)).collect()}
        assert {n: got.get(n, n) for n in ids} == union(ids, pairs)


def test_signatures_do_not_depend_on_neighbours():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 2**32, n, np.uint32)) for n in (1, 40, 9_000, 5, 3_000, 1, 700)]
    together = paragraph_dedup.bands(sets, [0, 1, 0, 1, 0, 1, 0])
    for i, own in enumerate(sets):
        assert together[i].tolist() == paragraph_dedup.bands([own], [i % 2])[0].tolist()
    lines = [[b"a"], [b"%d" % i for i in range(90)], [b"x", b"y", b"x"], [b"z"] * 50]
    for line, own in zip(lines, paragraph_dedup.shingles(lines)):
        assert own.tolist() == paragraph_dedup.shingles([line])[0].tolist()
        assert len(own) == len({tuple(line[i : i + 5]) for i in range(max(1, len(line) - 4))})


def test_passage_edges(spark):
    text = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, text), (1, text), (2, text), (3, text + "\n" + text), (4, "short one.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    out = paragraph_dedup.without_repeats(df)
    assert out.columns == df.columns
    # Repeated rows are one document, and keep their text together.
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, text), (1, text), (2, ""), (3, ""), (4, "short one.")]
    assert paragraph_dedup.passage_report(df.limit(0)).count() == 0


def _words(draw, n):
    return ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(4, 9))) for _ in range(n)]


def test_passages_amid_sentences_and_beside_others(spark):
    draw = random.Random(12)
    p, q, long = (" ".join(_words(draw, n)) for n in (60, 55, 70))
    own = [" ".join(_words(draw, 50)) for _ in range(9)]
    inner = " ".join(long.split()[30:42])
    rows = [
        # Amid a sentence, without stops.
        (1, f"{own[0]}, {p} {own[1]}"),
        (2, f"{own[2]} {p}, {own[3]}"),
        # Next to another one that is as frequent, both also alone.
        (3, f"{own[4]} {p} {q} {own[5]}"),
        (4, f"{own[6]} {q} {own[7]}"),
        # A part of the passage stands elsewhere as well.
        (5, f"{own[8]} {long}"),
        (6, f"{long} {own[0][:20]}"),
        (7, f"uno {inner} dos"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: " ".join(r["text"].split()) for r in paragraph_dedup.without_repeats(df).collect()}
    assert out[1] == rows[0][1] and out[5] == rows[4][1] and out[7] == rows[6][1]
    # Up to a word next to the passage may be equal by its comma only.
    assert p.split()[10] not in out[2] and out[2].startswith(own[2]) and own[3] in out[2]
    assert out[3] == f"{own[4]} {q} {own[5]}"
    assert out[4] == f"{own[6]} {own[7]}"
    assert out[6] == own[0][:20].strip()


def test_unique_words_inside_a_repeated_run_stay(spark):
    draw = random.Random(13)
    first, last = (" ".join(_words(draw, 50)).capitalize() + "." for _ in range(2))
    rows = [(1, f"{first} Name: Bob. {last}"), (2, f"{first} Total: 42. {last}")]
    # Short lines, so that only the runs count.
    rows = [(i, "\n".join(" ".join(t.split()[k : k + 10]) for k in range(0, 102, 10))) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in paragraph_dedup.without_repeats(df).collect()}
    assert out[1] == rows[0][1]
    assert out[2].split() == ["Total:", "42."]


def test_pipeline(spark, docs):
    """Each stage against its operator in plain Python, on its own input."""
    folder, now, seen = SMALL, docs, []
    for name, step in corpus_pipeline.STAGES:
        after = step(spark, now, folder)
        if name != "tokens":
            assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), after.schema)
        seen.append((name, now.collect(), after.collect()))
        now = after
    by_name = {n: (a, b) for n, a, b in seen}
    before, after = by_name["simhash"]
    bits = {r["doc_id"]: simhash.text_fingerprint(r["text"]) for r in before}
    ids = sorted(bits)
    want = union(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (bits[a] ^ bits[b]).bit_count() <= 4])
    assert {r["doc_id"] for r in after} == set(want.values())
    before, after = by_name["quality"]
    assert {r["doc_id"] for r in after} < {r["doc_id"] for r in before}
    before, after = by_name["passages"]
    assert [r["doc_id"] for r in sorted(before)] == sorted(r["doc_id"] for r in after)
    assert all(len(x["text"]) >= len(y["text"]) for x, y in zip(sorted(before), sorted(after, key=lambda r: r["doc_id"])))
    before, after = by_name["mixing"]
    texts = {(r["doc_id"], r["text"]) for r in before}
    assert all((r["doc_id"], r["text"]) in texts for r in after)
    total = sum(len((r["text"] or "").split()) for r in before)
    assert abs(sum(len(r["text"].split()) for r in after) - 1.5 * total) < 3_000
    assert len(by_name["tokens"][1]) == len(after)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, by_name["tokens"][1]))


def test_every_query_is_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, len(QUERIES) + 1))
    assert table(spark, SMALL, "pages").count() == QUERIES["op6_html"](spark, SMALL).count()


def test_anchors_and_stretches_against_every_window():
    draw = np.random.default_rng(3)
    for _ in range(200):
        hashes, window, least = draw.integers(0, 6, draw.integers(0, 60)), int(draw.integers(1, 25)), int(draw.integers(1, 45))
        starts = range(max(0, len(hashes) - window + 1))
        chosen = paragraph_dedup.anchors(hashes, window)
        assert chosen.tolist() == [i + int(hashes[i : i + window].argmin()) for i in starts]
        places = np.unique(draw.choice(chosen, 3)) if len(chosen) else chosen
        known, expected = [c in places for c in chosen], set()
        for first in starts:
            last = first
            while last < len(known) and known[last]:
                last += 1
            if last > first and (first == 0 or not known[first - 1]) and last - first + window - 1 >= least:
                expected.update(range(first, last + window - 1))
        assert paragraph_dedup.near(chosen, places, window, least).tolist() == sorted(expected)


def test_equal_paragraphs_of_a_batch_hold_their_elements_once(spark):
    line = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(i, 0, f"{line}\nown {i}") for i in range(6)], "doc_id bigint, tie bigint, text string").coalesce(1)
    rows = paragraph_dedup.units(docs, 40).filter(f"kind = {paragraph_dedup.LINE}").collect()
    assert len(rows) == 6 and len({r["digest"] for r in rows}) == 1
    (full,) = [r for r in rows if r["elements"] is not None]
    assert len(full["elements"]) == 46 and len(full["bands"]) == paragraph_dedup.BANDS
    assert sum(r["bands"] is None for r in rows) == 5
    found = paragraph_dedup.repeated_passages(docs.select("doc_id", "text")).collect()
    assert {r["doc_id"] for r in found if not r["kept"]} == {1, 2, 3, 4, 5}


def test_words_of_a_text_are_hashed_once_for_anchors_and_lines(monkeypatch):
    draw = random.Random(4)
    words = ["a", "Bc", "\u03a3", "A\u03a3", "\u0130x", *(f"w{i}" for i in range(60))]
    breaks = [" ", " ", " ", " ", "\t", "\r", "\x0b", "\x85", "\u2028", "\n", "\n\n", "\n \n"]
    hashed, plain = [], paragraph_dedup.word_hashes
    monkeypatch.setattr(paragraph_dedup, "word_hashes", lambda w: hashed.append(len(w)) or plain(w))
    for n in (0, 1, 4, 5, 60, 400):
        text = "".join(draw.choice(words) + draw.choice(breaks) for _ in range(n))
        for least in (3, 12):
            hashed.clear()
            whole, lines = paragraph_dedup.text_parts(text, least)
            assert hashed == [len(text.split())]
            assert whole.tolist() == paragraph_dedup.word_shingles(text).tolist()
            at, expected = 0, []
            for line in (part.lower().split() for part in text.split("\n")):
                if len(line) >= least:
                    own = paragraph_dedup.unit(paragraph_dedup.LINE, at, at + len(line), len(line), paragraph_dedup.shingles([line])[0])
                    expected.append(own | {"elements": own["elements"].tolist()})
                at += len(line)
            assert [u | {"elements": u["elements"].tolist()} for u in lines] == expected


def test_copies_are_found_without_reading_texts_again(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(3, text), (1, text), (1, text), (None, text), (4, other), (4, other), (5, "short"), (6, "short"), (7, None), (8, "")]
    found = paragraph_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    # The result comes from stored tables; no text is digested or split in it.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "regexp_extract_all" not in plan
    got = sorted(((r["doc_id"], r["start"], r["stop"], r["n_words"], r["kept_doc_id"], r["kept"]) for r in found.collect()), key=str)
    assert got == [(1, 0, 50, 50, None, False), (3, 0, 50, 50, None, False), (None, 0, 50, 50, None, True)]
