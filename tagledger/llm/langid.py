"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in Spark, on documents outside the held-out third with a
language; for languages with many documents a fixed number of them, chosen by a hash of
the id, is enough.  The log-probability matrix (buckets times languages) is broadcast, and
texts are scored many at a time: a batch is a sparse matrix of n-gram counts, one row per text, and
its product with the matrix of log-probabilities gives all scores.

Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing
could be learned.  Equal scores go to the language that comes first in code point order.  At most ``MAX_LANGUAGES``
languages are learned, those of most documents, so the matrix has a bounded size.  Repeated rows and null ids are rows like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.llm.ngrams import char_ngrams, code_points, held_out

HASH_BITS = 16
SIZES = (1, 2, 3, 4)
SMOOTHING = 0.1
DOCS_PER_LANGUAGE = 5_000  # about as many documents of a language are learned from, at most
MAX_LANGUAGES = 500
UNKNOWN = "und"
_SLICE = 1 << 17
_GRAMS = 1 << 20  # n-grams of a batch that are multiplied at once
_OTHER = regex.compile(r"[\W\d_]+")


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text's letters, in slices; none if there is no letter."""
    letters = _OTHER.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):
        return
    points = code_points(f" {letters} ")
    for start in range(0, len(points), _SLICE):
        for n in SIZES:
            yield char_ngrams(points[start : start + _SLICE + n - 1], n, HASH_BITS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            own = counts.setdefault(lang, np.zeros(1 << HASH_BITS, np.int64))
            for at in grams(text):
                own += np.bincount(at, minlength=1 << HASH_BITS)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.record_batch(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])],
            names=["lang", "bucket", "n"],
        )


def train(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, most: int = MAX_LANGUAGES) -> dict:
    """Languages, priors and the matrix of log-probabilities."""
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequent = known.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "_lang")
    # At most ``most`` rows.
    sizes = {r["_lang"]: r["_n"] for r in frequent.limit(most).collect()}
    languages = sorted(sizes)
    if not languages:
        return {"languages": []}
    parts = docs.sparkSession.createDataFrame([(x, max(1, n // per_language)) for x, n in sizes.items()], "_lang string, _parts long")
    sample = known.join(F.broadcast(parts), F.col("lang") == F.col("_lang"))
    sample = sample.filter(F.pmod(F.xxhash64("doc_id"), F.col("_parts")) == 0).select("lang", "text")
    counted = sample.mapInArrow(_count, "lang string, bucket int, n bigint")
    # One row per language and bucket.
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((1 << HASH_BITS, len(languages)))
    counts[rows["bucket"], rows["lang"].map(languages.index).astype(int)] = rows["n"]
    chance = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=0)
    docs_of = np.array([sizes[x] for x in languages], float)
    return {"languages": languages, "matrix": np.log(chance).astype(np.float32), "prior": np.log(docs_of / docs_of.sum())}


def _add_product(rows: np.ndarray, at: np.ndarray, matrix: np.ndarray, totals: np.ndarray) -> None:
    """Add to the totals the product of the sparse counts of (row, bucket) with the matrix."""
    keys, counts = np.unique(rows * matrix.shape[0] + at, return_counts=True)
    row, bucket = keys // matrix.shape[0], keys % matrix.shape[0]
    firsts = np.flatnonzero(np.diff(row, prepend=-1))
    totals[row[firsts]] += np.add.reduceat(matrix[bucket].astype(np.float64) * counts[:, None], firsts, axis=0)


def predict_all(texts: list[str | None], model: dict) -> tuple[list[str], list[float]]:
    """The likeliest language and its probability for each text."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model["languages"]:
        return names, scores
    totals = np.zeros((len(texts), len(model["languages"])))
    seen = np.zeros(len(texts), bool)
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def multiply():
        rows = np.repeat([n for n, _ in held], [len(at) for _, at in held])
        _add_product(rows, np.concatenate([at for _, at in held]), model["matrix"], totals)
        held.clear()

    for n, text in enumerate(texts):
        for at in grams(text) if text else ():
            seen[n] = True
            held.append((n, at))
            size += len(at)
            if size > _GRAMS:
                multiply()
                size = 0
    if held:
        multiply()
    totals += model["prior"]
    best = totals.argmax(axis=1)
    odds = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
    for n in np.flatnonzero(seen).tolist():
        names[n], scores[n] = model["languages"][best[n]], float(odds[n])
    return names, scores


def predict(text: str | None, model: dict) -> tuple[str, float]:
    names, scores = predict_all([text], model)
    return names[0], scores[0]


def language(text: Column, shared) -> Column:
    """Struct of lang_pred and score."""

    @F.arrow_udf("lang_pred string, score double")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = predict_all(batch.to_pylist(), shared.value)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    return scan(text)


def identify(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Add lang_pred and score; columns of these names are replaced."""
    found = df.withColumn("_language", language(F.col(f"`{text}`"), df.sparkSession.sparkContext.broadcast(model)))
    return found.withColumns({"lang_pred": F.col("_language.lang_pred"), "score": F.col("_language.score")}).drop("_language")


def language_report(docs: DataFrame) -> DataFrame:
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
