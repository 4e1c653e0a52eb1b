"""A query for each operator over the test tables, and its SQL where there is one."""

from __future__ import annotations

import public_tokenizers

from tagledger.llm.bpe import digests
from tagledger.llm.embedding_dedup import near_duplicate_vectors
from tagledger.llm.fingerprints import fingerprint_neighbours
from tagledger.llm.html_text import page_report
from tagledger.llm.langid import language_report
from tagledger.llm.licenses import license_report, license_sql
from tagledger.llm.mixing import mixing_report, mixing_sql
from tagledger.llm.paragraph_dedup import passage_report
from tagledger.llm.pii import pii_report
from tagledger.llm.quality import quality_report
from tagledger.llm.resampling import resampling_report, resampling_sql
from tagledger.llm.simhash import simhash_report
from tagledger.llm.spelling import spelling_report, spelling_sql
from tagledger.llm.tables import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES = {
    "op1_bpe": lambda spark, folder: digests(table(spark, folder, "documents"), TOKENIZER),
    "op2_licenses": lambda spark, folder: license_report(table(spark, folder, "documents")),
    "op3_mixing": lambda spark, folder: mixing_report(table(spark, folder, "documents")),
    "op4_fingerprints": lambda spark, folder: fingerprint_neighbours(table(spark, folder, "documents")),
    "op5_language": lambda spark, folder: language_report(table(spark, folder, "documents")),
    "op6_html": lambda spark, folder: page_report(table(spark, folder, "pages")),
    "op7_embeddings": lambda spark, folder: near_duplicate_vectors(table(spark, folder, "embeddings")),
    "op8_simhash": lambda spark, folder: simhash_report(table(spark, folder, "documents")),
    "op9_quality": lambda spark, folder: quality_report(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    ),
    "op10_passages": lambda spark, folder: passage_report(table(spark, folder, "documents")),
    "op11_spelling": lambda spark, folder: spelling_report(table(spark, folder, "documents")),
    "op12_resampling": lambda spark, folder: resampling_report(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ),
    "op13_pii": lambda spark, folder: pii_report(table(spark, folder, "documents")),
}

ORACLES = {
    "op2_licenses": license_sql(),
    "op3_mixing": mixing_sql(),
    "op11_spelling": spelling_sql(),
    "op12_resampling": resampling_sql(),
}
