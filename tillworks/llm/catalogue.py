"""Name to query, and the same query in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillworks.llm import (
    chunk_fingerprints,
    collocations,
    divergence,
    exact_dedup,
    license_scan,
    ngram_join,
    packing,
    piece_codec,
    pii,
    simhash,
    token_counts,
    toxicity,
    url_rules,
)
from tillworks.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_documents(spark, sf_dir))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.url_verdicts(table(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_documents(spark, sf_dir))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trips(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_fingerprints.fingerprints(_documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_groups(_documents(spark, sf_dir), words=3, bits=2)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined_documents(_documents(spark, sf_dir), words=4, percent=85)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(_documents(spark, sf_dir))


EXACT_DEDUP_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
grouped AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM texts JOIN grouped USING (text)
"""


_QUERIES = [
    op1_personal_data,
    op2_url_filters,
    op3_license_scan,
    op4_piece_codec,
    op5_document_fingerprints,
    op6_exact_dedup,
    op7_simhash_near_dedup,
    op8_token_counts,
    op9_toxicity,
    op10_packing,
    op11_collocations,
    op12_ngram_join,
    op13_source_divergence,
]


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_license_scan": license_scan.license_scan_sql(),
        "op6_exact_dedup": EXACT_DEDUP_SQL,
        "op11_collocations": collocations.COLLOCATION_SQL,
        "op13_source_divergence": divergence.DIVERGENCE_SQL,
    }
