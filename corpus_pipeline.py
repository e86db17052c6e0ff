"""The corpus pipeline: toxicity, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir). Its result is written as Parquet in the shared folder and read again as the next
stage's docs. All stages but the last return the columns of ``documents``:

1. ``toxicity``: documents that the learned lexicon predicts toxic go.
2. ``exact_dedup``: of equal texts the row with the largest doc_id stays.
3. ``near_dedup``: of documents that reach each other by similar sets of five-word shingles (0.8 or more) the one with
   the smallest doc_id stays.
4. ``personal_data``: every span found is replaced by its kind in brackets, and n_chars is brought up to date.
5. ``packing``: the texts' ids are packed into sequences; one row per piece.

Null and empty texts, repeated rows and empty tables are treated as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillworks.llm import exact_dedup, packing, pii, simhash, toxicity
from tillworks.llm.common import table
from tillworks.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), taught_by=table(spark, sf_dir, "documents"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs, words=5, similarity=0.8)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.without_personal_data(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: The learned stages and the packing cannot be said in SQL; tests/llm/test_pipeline.py checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
