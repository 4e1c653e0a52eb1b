"""BPE encoding and decoding of text columns.

Encoding is exact for the vocabulary's merges: an Aho-Corasick automaton gives the
longest token at every place, and a table of compatible pairs decides which of them
BPE would really make (``vocabulary.Vocabulary``).  Decoding reads token strings out
of one buffer by an offset table.  Both are narrow operators: no shuffle, one batch of
rows at a time; the tables are broadcast and their size is that of the vocabulary file.

Null and empty texts give no tokens.  Rows are kept as they are, copies included; a
column of the output's name is replaced, other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagledger.llm.vocabulary import Vocabulary

_open: dict[tuple[int, bool], Vocabulary] = {}


def _tables(shared, encoder: bool) -> Vocabulary:
    """One set of tables per worker process; decoding needs only the small ones."""
    key = (shared.value["key"], encoder)
    if key not in _open:
        _open[key] = Vocabulary.parse(shared.value["source"], encoder)
    return _open[key]


def _broadcast(spark: SparkSession, tokenizer: str):
    with open(tokenizer, encoding="utf-8") as file:
        source = file.read()
    return spark.sparkContext.broadcast({"key": hash(source), "source": source})


def token_ids(text: Column, shared) -> Column:
    """Array of token ids; empty for null."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = _tables(shared, True)
        for batch in batches:
            rows = [tables.encode(t) if t else np.empty(0, "<u4") for t in batch.to_pylist()]
            ends = np.cumsum([0, *map(len, rows)])
            flat = np.concatenate([*rows, np.empty(0, "<u4")]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return encode(text)


def token_text(ids: Column, shared) -> Column:
    """Text of an array of token ids; empty for null."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = _tables(shared, False)
        for batch in batches:
            flat, ends = batch.flatten().to_numpy(zero_copy_only=False), np.zeros(len(batch) + 1, int)
            sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            np.cumsum(sizes, out=ends[1:])
            yield pa.array([tables.decode(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.string())

    return decode(ids)


def round_trip(text: Column, shared) -> Column:
    """Token count, SHA-256 (hex) of the ids as little-endian 32-bit integers, and of the text they decode to.

    Both ways in one worker, so a task needs one set of tables and ids stay where they are made.
    """

    @F.arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = _tables(shared, True)
        for batch in batches:
            sizes, coded, decoded = [], [], []
            for value in batch:
                ids = tables.encode(value.as_py() or "")
                sizes.append(len(ids))
                coded.append(sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(sha256(tables.decode(ids).encode()).hexdigest())
            columns = [pa.array(sizes, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    return both(text)


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Add the token ids of ``text``."""
    return df.withColumn(ids, token_ids(F.col(f"`{text}`"), _broadcast(df.sparkSession, tokenizer)))


def decode(df: DataFrame, tokenizer: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """Add the text of ``ids``."""
    return df.withColumn(text, token_text(F.col(f"`{ids}`"), _broadcast(df.sparkSession, tokenizer)))


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per document: token count and digests of the ids and of the decoded text."""
    coded = round_trip(F.col("text"), _broadcast(docs.sparkSession, tokenizer))
    both = docs.select("doc_id", coded.alias("_coded"))
    return both.select("doc_id", "_coded.n_tokens", "_coded.ids_sha256", "_coded.decoded_sha256")
