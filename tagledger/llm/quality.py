"""Quality classifier: supervised embeddings of hashed words and character n-grams.

A document is the average of the vectors of its features: words, word pairs, "the word
some places before again", and character n-grams, hashed to a table of fixed size.  A
softmax over two classes, with the classes' shares as bias, is trained with numpy by stochastic gradient descent on a bounded
sample of labelled documents.  As the output is linear in the average, scoring needs one
number per feature, and the model that is broadcast is half a megabyte at any corpus size.

Labels are learned only from rows outside the held-out third.  Null and empty texts have no
features and get the score of the bias alone.  Several labels of one id: the smallest counts;
null labels or ids are not learned from.  Without any labels every score is 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.llm.ngrams import buckets, char_ngrams, code_points, held_out, word_keys

HASH_BITS = 17
WIDTH = 8
CHARS = (3, 4)
BACK = (1, 2, 3, 4)
MAX_LABELLED = 3_000  # labelled documents that the model is fitted on, at most
STEPS = 18_000  # documents that training looks at, repeats counted; the same for any sample
RATE = 0.5
LEAST = 10  # added to the number of features, so that a few of them decide less
_SLICE = 1 << 18  # code points that are turned into features at once


def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all features of a text, in slices of bounded size."""
    points = code_points(text or "")
    for start in range(0, len(points), _SLICE):
        part = points[max(0, start - max(CHARS) + 1) : start + _SLICE]
        for n in CHARS:
            yield char_ngrams(part[max(0, max(CHARS) - n) if start else 0 :], n, HASH_BITS)
    words = word_keys(points)
    yield buckets(words, HASH_BITS, 11)
    yield buckets(words[:-1] * np.uint64(3) + words[1:], HASH_BITS, 12)
    for back in BACK:
        again = words[back:] == words[:-back] if len(words) > back else np.empty(0, bool)
        yield buckets(again.astype(np.uint64), HASH_BITS, 20 + back)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their shares."""
    found = np.concatenate([np.empty(0, np.int64), *features(text)])
    known, counts = np.unique(found, return_counts=True)
    return known.astype(np.int32), (counts / (len(found) + LEAST)).astype(np.float32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> tuple[np.ndarray, float]:
    """A weight per feature and the bias: log-odds of class 1."""
    draw = np.random.default_rng(7)
    table = draw.uniform(-1 / WIDTH, 1 / WIDTH, (1 << HASH_BITS, WIDTH)).astype(np.float32)
    output = np.zeros((2, WIDTH), np.float32)
    seen = np.bincount(labels, minlength=2) + 1
    bias = np.log(seen / seen.sum()).astype(np.float32)
    step = 0
    while bags and step < STEPS:
        for i in draw.permutation(len(bags))[: STEPS - step]:
            rate = RATE * (1 - step / STEPS)
            step += 1
            at, share = bags[i]
            mean = share @ table[at]
            logits = output @ mean + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            back = error @ output
            output -= rate * np.outer(error, mean)
            # The step in the average itself is at most ``rate`` times the gradient.
            scale = min(len(at) ** 0.5, 1 / max(float(share @ share), 1e-9))
            table[at] -= (rate * scale) * np.outer(share, back)
    return table @ (output[1] - output[0]), float(bias[1] - bias[0])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [bag(t) for t in batch.column("text").to_pylist()]
        yield pa.record_batch(
            [
                pa.array([1] * len(found), pa.int32()),
                batch.column("doc_id"),
                batch.column("label"),
                pa.array([f.tobytes() for f, _ in found], pa.binary()),
                pa.array([s.tobytes() for _, s in found], pa.binary()),
            ],
            names=["all", "doc_id", "label", "at", "share"],
        )


def _train(group: pa.Table) -> pa.Table:
    order = np.argsort(np.array(group.column("doc_id").to_pylist()), kind="stable")
    at, share = group.column("at").to_pylist(), group.column("share").to_pylist()
    bags = [(np.frombuffer(at[i], np.int32), np.frombuffer(share[i], np.float32)) for i in order]
    labels = group.column("label").to_pylist()
    weights, bias = fit(bags, [labels[i] for i in order])
    return pa.table({"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()), "bias": [bias]})


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict:
    """Fit the model in one task on at most ``max_labelled`` labelled documents, chosen by a hash of their ids."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # A bounded number of ids with one label each.
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("int").alias("label"))
    chosen = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    sample = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text")
    shape = f"all int, doc_id {dict(docs.dtypes)['doc_id']}, label int, at binary, share binary"
    rows = sample.mapInArrow(_bags, shape).groupBy("all").applyInArrow(_train, "weights binary, bias double").collect()
    if not rows:
        return {"weights": np.zeros(1 << HASH_BITS, np.float32), "bias": np.inf}
    return {"weights": np.frombuffer(rows[0]["weights"], np.float32), "bias": rows[0]["bias"]}


def text_score(text: str | None, model: dict) -> float:
    total, count = 0.0, 0
    for at in features(text):
        total += float(model["weights"][at].sum(dtype=np.float64))
        count += len(at)
    odds = model["bias"] + total / (count + LEAST)
    return float(1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def quality(text: Column, shared) -> Column:
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([text_score(t, shared.value) for t in batch.to_pylist()], pa.float64())

    return score(text)


def score_quality(df: DataFrame, model: dict, text: str = "text", score: str = "score") -> DataFrame:
    """Add the probability that a text is good; a column of that name is replaced."""
    return df.withColumn(score, quality(F.col(f"`{text}`"), df.sparkSession.sparkContext.broadcast(model)))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the model does not reject, with their own columns."""
    scored = score_quality(docs, train(docs, labels), score="_quality")
    return scored.filter("_quality >= 0.5").drop("_quality")
