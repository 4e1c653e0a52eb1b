"""Importance resampling towards a target distribution, over hashed n-grams of words.

Texts become words by Arrow kernels: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten``; a
``dictionary_encode`` gives every word a number.  Numbers shifted by one place form pairs, pairs and the
next word form triples; each kind is dictionary-encoded in turn, so a checksum is
computed once per distinct n-gram of a slice, from that of its beginning.  The checksum
modulo the number of buckets is the feature.  A bucket's gain is the logarithm of how much likelier
the target is to have it; a document's weight is the sum of its gains, taken by bucket and
added up per document.  Gumbel noise from a digest of the id makes the largest
scores a sample without replacement, the same in every run.

How it scales: two passes over the texts, without a shuffle of texts.  The first counts buckets, one
table of them per task; the gains, one number per bucket, are broadcast.  Only ids and scores
are sorted, and of these only the rows that may be drawn: a quantile sketch gives a score that is below
the last drawn one, a count proves it, and all rows above it are numbered exactly over many tasks.
Work inside a task goes over slices of bounded size, also within one very long text.

Null and empty texts have no words, weight 0, and are never drawn.  A null id reads as empty text and comes before others
among equal scores; rows equal in id and score are numbered in any order.  An empty target or empty corpus gives gains of the
other's smoothed counts.  Of the given tables only the named columns are read, whatever other columns are called.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.llm.spelling import CRC_TABLE_SQL, crc_sql
from tagledger.operators.ordering import global_row_number
from tagledger.session import stage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST = 3  # words of a feature
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
TEXT_BYTES = 4 << 20  # of texts that are split at once; a longer text is split alone
SLICE_WORDS = 1 << 19  # words whose features are made at once


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in one array, and the text that each is of."""
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    flat = pc.list_flatten(split)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    real = pc.not_equal(flat, "")
    return flat.filter(real), owner[real.to_numpy(zero_copy_only=False)]


def feature_buckets(words: pa.Array, owner: np.ndarray, size: int, longest: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, bucket) of all features, a kind of a slice at a time, owners ascending."""
    for start in range(0, len(words), step):
        own = owner[start : start + step + longest - 1]
        coded = pc.dictionary_encode(words.slice(start, step + longest - 1))
        index = coded.indices.to_numpy().astype(np.int64)
        names = [w.encode() for w in coded.dictionary.to_pylist()]
        tails = [b" " + w for w in names]
        codes, sums = index, np.fromiter(map(zlib.crc32, names), np.int64, len(names))
        here = min(step, len(words) - start)
        yield own[:here], sums[codes[:here]] % size
        for more in range(1, longest):
            if len(index) <= more:
                break
            grown = pc.dictionary_encode(pa.array(codes[: len(index) - more] * len(names) + index[more:]))
            distinct = grown.dictionary.to_numpy()
            ends = map(tails.__getitem__, (distinct % len(names)).tolist())
            sums = np.fromiter(map(zlib.crc32, ends, sums[distinct // len(names)].tolist()), np.int64, len(distinct))
            codes = grown.indices.to_numpy().astype(np.int64)
            inside = np.flatnonzero(own[: min(here, len(codes))] == own[more : more + min(here, len(codes))])
            yield own[inside], sums[codes[inside]] % size


def _pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of bytes, of one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
        groups = np.cumsum(sizes) // TEXT_BYTES
        edges = np.flatnonzero(np.diff(groups, prepend=-1, append=-1))
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def count_buckets(texts: DataFrame, text: str = "text", size: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n) of the features of all texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for piece in _pieces(batches):
            for _, at in feature_buckets(*split_words(piece.column("text")), size, longest, SLICE_WORDS):
                total += np.bincount(at, minlength=size)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(scan, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, size: int = BUCKETS) -> np.ndarray:
    """A thousand times the log-ratio of each bucket, rounded down; both tables have at most ``size`` rows."""
    counts = []
    for counted in (corpus, target):
        own = [0] * size
        for row in counted.collect():
            own[row["bucket"]] = row["n"]
        counts.append(own)
    s_all, t_all = (float(sum(own) + size) for own in counts)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(*counts)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_: str = "doc_id", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for piece in _pieces(batches):
            words, owner = split_words(piece.column("text"))
            n_features, weight = np.zeros((2, piece.num_rows), np.int64)
            for own, at in feature_buckets(words, owner, len(known), longest, SLICE_WORDS):
                if len(own):
                    first = np.flatnonzero(np.diff(own, prepend=-1))
                    weight[own[first]] += np.add.reduceat(np.take(known, at), first)
                    n_features[own[first]] += np.diff(first, append=len(own))
            n_words = np.bincount(owner, minlength=piece.num_rows)
            columns = [piece.column("doc_id"), *map(pa.array, (n_words, n_features, weight))]
            yield pa.record_batch(columns, names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(f"`{id_}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(scan, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_features long, weight long")


def gumbel(id_: Column, seed: int = SEED) -> Column:
    """A thousand times Gumbel noise by a digest of the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    code = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((code + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Add ``rank`` to (doc_id, n_words, score, …): 1, 2, … for the drawn rows, null for the others."""
    able = F.col("n_words") >= least_words
    # A little lower than the quantile asked for, by more than the sketch's error.
    low = F.percentile_approx(F.when(able, F.col("score")), max(0.0, 1 - percent / 100 - 0.001), F.lit(10_000))
    found = scored.agg(F.count_if(able).alias("n"), low.alias("low")).first()
    wanted = percent * found["n"] // 100
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = able & (F.col("score") >= found["low"])
    if scored.filter(high).count() < wanted:
        high = able
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    ranked = global_row_number(scored.filter(high), order, "rank")
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return drawn.unionByName(scored.filter(~high).withColumn("rank", F.lit(None).cast("long")))


def resampling_report(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document."""
    gains = bucket_gains(
        count_buckets(docs, size=buckets, longest=longest), count_buckets(target, size=buckets, longest=longest), buckets
    )
    weighed = weigh(docs, gains, longest=longest)
    scored = stage(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "resampling-scores")
    return draw(scored, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def resampling_sql() -> str:
    """The same in DuckDB."""
    return f"""
WITH {CRC_TABLE_SQL},
texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS i, doc_id, text FROM documents
  UNION ALL SELECT 't', 0, NULL, text FROM benchmark
), split AS MATERIALIZED (
  SELECT kind, i, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), features AS MATERIALIZED (
  SELECT kind, i, f, count(*) AS k FROM (
    SELECT kind, i, unnest(w) AS f FROM split
    UNION ALL SELECT kind, i, unnest(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) FROM split
    UNION ALL SELECT kind, i, unnest(list_transform(range(1, len(w) - 1), lambda j: w[j] || ' ' || w[j + 1] || ' ' || w[j + 2])) FROM split
  ) GROUP BY ALL
), coded AS MATERIALIZED (
  SELECT f, {crc_sql("x")} % 10000 AS b FROM (SELECT DISTINCT f, hex(f) AS x FROM features), _crc
), counted AS (
  SELECT kind, b, sum(k) AS n FROM features JOIN coded USING (f) GROUP BY ALL
), gains AS MATERIALIZED (
  SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS b)
  LEFT JOIN (SELECT b, n FROM counted WHERE kind = 'd') s USING (b) LEFT JOIN (SELECT b, n FROM counted WHERE kind = 't') t USING (b),
  (SELECT coalesce(sum(n) FILTER (kind = 'd'), 0) AS s_all, coalesce(sum(n) FILTER (kind = 't'), 0) AS t_all FROM counted)
), weighed AS (
  SELECT i, sum(k)::BIGINT AS n_features, sum(k * gain)::BIGINT AS weight
  FROM features JOIN coded USING (f) JOIN gains USING (b) WHERE kind = 'd' GROUP BY i
), scored AS (
  SELECT s.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split s LEFT JOIN weighed USING (i) WHERE s.kind = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS r,
    count(*) FILTER (n_words >= 20) OVER () AS n_able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= 5 * n_able // 100 THEN r END AS rank FROM ranked
"""
