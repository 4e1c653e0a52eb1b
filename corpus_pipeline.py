"""From documents to training tokens: filter, deduplicate, mix, encode.

Every stage takes (spark, docs, folder) and returns a DataFrame; it is written as Parquet
and read again as the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagledger.llm.bpe import digests
from tagledger.llm.mixing import mixed_documents
from tagledger.llm.paragraph_dedup import without_repeats
from tagledger.llm.quality import good_documents
from tagledger.llm.simhash import without_near_duplicates
from tagledger.llm.suite import TOKENIZER
from tagledger.llm.tables import table
from tagledger.session import stage


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    return good_documents(docs, table(spark, folder, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return without_near_duplicates(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Remove passages that an earlier document has."""
    return without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Take documents by the weights of their sources, some more than once."""
    return mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return digests(docs, TOKENIZER)


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("passages", passage_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: A classifier, components and an encoder are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, folder, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, folder), f"pipeline-{name}")
    return docs
