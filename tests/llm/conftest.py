from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = "word and another one, " * 6000
TEXTS = [
    (1, "The first text of all, with a mail to jo.doe@mail.example.com in it."),
    (2, "The first text of all, with a mail to jo.doe@mail.example.com in it."),
    (3, None),
    (4, ""),
    (5, "   \n\t "),
    (6, LONG),
    (7, LONG),
    (8, "x"),
    (9, "Ünïcödé text, 漢字 and 😀 emoji; ▁mark  two spaces "),
    (10, "Call +1 (555) 123-4567 or 10.0.0.255 or 4111 1111 1111 1111."),
    (11, "the FIRST text of all, with a mail to jo.doe@mail.example.com in it."),
    (12, None),
    (None, "a row without an id"),
    (8, "x"),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and long texts, ties, a repeated row, and columns named like inner ones."""
    extra = "key string, digest string, bucket long, page int, fp long, file long, range double, spans string, score double"
    rows = [(d, t, None, None, len(t or ""), "k", "d", 1, 2, 3, 4, 5.0, "s", 0.5) for d, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
