"""Document fingerprints: the hashes of all word shingles below a fixed fraction of the hash range.

The sketch of a text grows with it, so a page that quotes a book keeps its share of the
book's hashes: intersections estimate how much of one text is in another, however unequal
they are, and the sketch of a collection is the union of its sketches.  A text none of
whose hashes is below the fraction keeps its smallest one, so only texts without words
have an empty sketch.

``fingerprint_neighbours`` also compares each document with the next one in id order.  The table
is cut into ranges of (id, hash of the text) that are even whatever the ids are; a range also
gets the first document of the next.  Texts are shuffled once.

Null texts count as empty.  Null ids come first; equal ids are ordered by a hash of the text.
A single document is its own next.  Texts without words have likeness 1 to each other, else 0.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 5
FRACTION = 8  # one hash in so many is kept
_HEX = 16
_ODD = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) & (2**64 - 1)) for i in range(16)]
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """A 64-bit hash of each run of words (fewer words: one run)."""
    digest = xxhash.xxh3_64_intdigest
    own = np.array([digest(w) for w in text.encode("utf-8", "surrogatepass").lower().split()], np.uint64)
    if not len(own):
        return own
    width = min(words, len(own))
    count = len(own) - width + 1
    mixed = np.zeros(count, np.uint64)
    for i in range(width):
        mixed += own[i : i + count] * _ODD[i % 16]
    mixed ^= mixed >> np.uint64(30)
    mixed *= _STEP
    return mixed ^ mixed >> np.uint64(31)


def sketch(text: str | None, words: int = WORDS, fraction: int = FRACTION) -> np.ndarray:
    """Sorted distinct hashes below the fraction, or the smallest."""
    hashes = shingle_hashes(text or "", words)
    kept = np.unique(hashes[hashes < np.uint64(2**64 // fraction)])
    return kept if len(kept) or not len(hashes) else hashes.min(keepdims=True)


def merge(a: np.ndarray, b: np.ndarray, fraction: int = FRACTION) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    both = np.union1d(a, b)
    kept = both[both < np.uint64(2**64 // fraction)]
    return kept if len(kept) else both[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a``'s shingles that are in ``b``."""
    return len(np.intersect1d(a, b, True)) / len(a) if len(a) else 1.0


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity."""
    shared = len(np.intersect1d(a, b, True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def shown(kept: np.ndarray) -> str:
    """The sketch as text, 16 hexadecimal digits per hash."""
    return kept.astype(">u8").tobytes().hex()


def fingerprints(text: Column, words: int = WORDS, fraction: int = FRACTION) -> Column:
    """The sketch of a text column, as text."""

    @F.arrow_udf("string")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shown(sketch(t, words, fraction)) for t in batch.to_pylist()], pa.string())

    return scan(text)


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of a text; a column of that name is replaced."""
    return df.withColumn(out, fingerprints(F.col(f"`{text}`")))


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _order(id_, tie) -> tuple:
    return (0, 0, tie) if id_ is None else (1, id_, tie)


def _deal(starts: list[tuple]):
    """Range of every row; the first row of a range also goes to the range before it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = [_order(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist())]
            own = [max(0, bisect_right(starts, at) - 1) for at in where]
            extra = [n for n, (at, r) in enumerate(zip(where, own)) if at == starts[r]]
            take = pa.array([*range(len(own)), *extra])
            ranges = own + [(own[n] - 1) % len(starts) for n in extra]
            guests = [False] * len(own) + [True] * len(extra)
            # The guest of the last range is the first row of all; it comes last there.
            turned = [n >= len(own) and own[take[n].as_py()] == 0 for n in range(len(ranges))]
            columns = [batch.column(c).take(take) for c in ("doc_id", "tie", "text")]
            yield pa.record_batch(
                [pa.array(ranges, pa.int32()), pa.array(guests), pa.array(turned), *columns],
                names=["range", "guest", "turned", "doc_id", "tie", "text"],
            )

    return scan


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, each with the row behind it."""
    before = None  # (range, doc_id, text, sketch)
    for batch in batches:
        out = []
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        ranges, guests = batch.column("range").to_pylist(), batch.column("guest").to_pylist()
        for where, guest, id_, text in zip(ranges, guests, ids, texts):
            text = text or ""
            own = sketch(text)
            if before is not None and before[0] == where:
                changed = edited(before[2], text)
                other = sketch(changed)
                out.append(
                    {
                        "doc_id": before[1],
                        "n_chars": len(before[2]),
                        "edited_sha256": sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        "fingerprint": shown(before[3]),
                        "edited_fingerprint": shown(other),
                        "near_edited": likeness(before[3], other),
                        "near_next": likeness(before[3], own),
                    }
                )
            # Several rows may be the first of the next range; the first of them is its next.
            before = None if guest else (where, id_, text, own)
        shape = [("n_chars", pa.int64())] + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        shape = [("doc_id", batch.schema.field("doc_id").type), *shape, ("near_edited", pa.float64()), ("near_next", pa.float64())]
        yield pa.RecordBatch.from_pylist(out, pa.schema(shape))


def fingerprint_neighbours(df: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that of the next document."""
    spark = df.sparkSession
    docs = df.select(F.col(f"`{id_}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    docs = docs.withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select("doc_id", "tie").repartitionByRange(count, F.col("doc_id").asc_nulls_first(), "tie")
    # One row per range comes to the driver: the first (id, hash) of each.
    firsts = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")).alias("at"))
    starts = sorted({_order(r["at"]["doc_id"], r["at"]["tie"]) for r in firsts.collect()})
    kind = dict(docs.dtypes)["doc_id"]
    dealt = docs.mapInArrow(
        _deal(starts), f"range int, guest boolean, turned boolean, doc_id {kind}, tie bigint, text string"
    )
    placed = dealt.repartition("range").sortWithinPartitions(
        "range", "turned", F.col("doc_id").asc_nulls_first(), "tie", "guest"
    )
    shape = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string"
    return placed.mapInArrow(_compare, f"{shape}, near_edited double, near_next double")
