"""The pipeline's stages, each on its own input, and chunk fingerprints."""

from __future__ import annotations

import random

import brute
import corpus_pipeline
import numpy as np
import pytest
from brute_pii import base
from conftest import TEXTS
from test_copies import _similar

from tillworks.llm import chunk_fingerprints as chunks
from tillworks.session import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    """Input and result of each stage over the smallest tables."""
    docs, found = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, SF_DIR))
        found[name], docs = (docs, result), result
    return found


def _rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns_of_documents(staged):
    for name, (before, after) in list(staged.items())[:-1]:
        assert after.columns == before.columns, name


def test_toxic_documents_go(spark, staged):
    before, after = staged["toxicity"]
    gone = {d for d, _ in _rows(before)} - {d for d, _ in _rows(after)}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 0").collect()}
    assert not gone & clean


def test_toxic_texts_go_once_enough_is_labelled(spark):
    """Over the next larger tables, whose labels teach a lexicon."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, folder).select("doc_id").collect()}
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - kept
    marked = {label: {r.doc_id for r in labels.where(f"toxic = {label}").collect()} for label in (0, 1)}
    assert len(gone & marked[1]) > 0.6 * len(marked[1]) and len(gone & marked[0]) < 0.02 * len(marked[0])


def test_one_of_each_exact_copy_stays(staged):
    before, after = staged["exact_dedup"]
    last = {}
    for d, t in _rows(before):
        last[t or ""] = max(d, last.get(t or "", d))
    assert {d for d, _ in _rows(after)} == set(last.values())


def test_one_of_each_near_copy_stays(staged):
    before, after = staged["near_dedup"]
    assert {d for d, _ in _rows(after)} == _similar(_rows(before))


def test_base_spans_are_masked(staged):
    before, after = staged["personal_data"]
    masked = dict(_rows(after))
    for d, t in _rows(before):
        spans = base(t or "")
        if not spans:
            assert masked[d] == t
        for _, a, b in spans:
            assert t[a:b] not in masked[d]
    assert all(r.n_chars == len(r.text) for r in after.collect() if r.text is not None)


def test_every_id_is_packed_once(staged):
    before, after = staged["packing"]
    assert brute.check_packing(_rows(before), after.collect())["padding"] == 0


def test_run_gives_the_last_stage(spark, staged):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id", "doc_tokens").distinct().collect())
    want = sorted(tuple(r) for r in staged["packing"][1].select("doc_id", "doc_tokens").distinct().collect())
    assert got == want and set(columns) <= set(staged["packing"][1].columns)


def test_messy_rows_pass_all_stages(spark, messy):
    docs = messy
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR))
        if name != "packing":
            assert docs.columns == messy.columns, name
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {None, 2, 5, 7, 8, 9, 10}
    docs = messy.where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR))
    assert docs.count() == 0


# --- chunk fingerprints ---------------------------------------------------------------------------------


def test_edited_texts_equal_brute_force(small, small_rows):
    rows = chunks.fingerprints(small).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == brute.edits(small_rows)
    texts, sets = dict(small_rows), {}
    for r in rows:
        sets.setdefault(texts[r.doc_id] or "", set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(found) == 1 for found in sets.values())
    long = [r.near_edited for r in rows if r.n_chars > 400]
    assert np.mean(long) > 0.6


def test_fingerprints_of_messy_rows(spark, messy):
    with_id = messy.where("doc_id IS NOT NULL AND doc_id <> 8")
    rows = {r.doc_id: r for r in chunks.fingerprints(with_id).collect()}
    assert {d: (r.n_chars, r.edited_sha256) for d, r in rows.items()} == brute.edits([(d, t) for d, t in TEXTS if d not in (8, None)])
    assert rows[1].fingerprint == rows[2].fingerprint and rows[3].near_next == 1.0 and rows[4].near_next == 0.0
    assert chunks.fingerprints(messy).count() == len(TEXTS)
    one = chunks.fingerprints(messy.where("doc_id = 1")).collect()
    assert [r.doc_id for r in one] == [1] and one[0].near_next == 1.0
    assert chunks.fingerprints(messy.where("false")).count() == 0


def test_chunks_come_back_behind_an_insertion():
    random.seed(12)
    text = " ".join("".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(2000)).encode()
    moved = text[:5000] + b"something new in the middle" + text[5000:]
    assert chunks.containment(chunks.chunk_set(text), chunks.chunk_set(moved)) > 0.97
    sizes = np.diff(np.concatenate([[0], chunks.boundaries(np.frombuffer(text, dtype=np.uint8))]))
    assert sizes.sum() == len(text) and sizes[:-1].min() >= chunks.LEAST and sizes.max() <= chunks.MOST
    assert chunks.NORMAL * 0.7 < sizes.mean() < chunks.NORMAL * 1.6


def test_gear_hash_depends_on_its_window_only():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 500).astype(np.uint8)
    whole = chunks.gear_hashes(data)
    assert (chunks.gear_hashes(data[100:])[31:] == whole[131:]).all()
    slow = 0
    for i, b in enumerate(data):
        slow = ((slow << 1) + int(chunks._gear()[b])) & 0xFFFFFFFF
        assert slow == int(whole[i])
