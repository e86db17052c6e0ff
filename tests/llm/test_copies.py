"""Exact and near copies."""

from __future__ import annotations

import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import TEXTS

from tillworks.llm import exact_dedup, simhash
from tillworks.llm.ngram_join import token_sets


def _exact(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    found = []
    for d, t in rows:
        own = groups[t or ""]
        keep = max((x for x in own if x is not None), default=None)
        found.append((d, keep, len(own), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(found, key=repr)


@pytest.mark.parametrize("settings", [{}, {"key_bits": 1}, {"bucket_rows": 1, "directory_bits": 3}, {"key_bits": 2, "bucket_rows": 2}])
def test_exact_groups_equal_brute_force(messy, settings):
    got = exact_dedup.exact_groups(messy, **settings).collect()
    assert sorted(map(tuple, got), key=repr) == _exact(TEXTS)


def test_exact_groups_of_real_texts(small, small_rows):
    got = exact_dedup.exact_groups(small, bucket_rows=5).collect()
    assert sorted(map(tuple, got), key=repr) == _exact(small_rows)


def test_directory_doubles_only_overfull_buckets(spark):
    rows = spark.range(1000).selectExpr("xxhash64(id) AS key", "1L AS group_size")
    lines = {r.prefix: r.depth for r in exact_dedup.directory(rows, bits=6, bucket_rows=100).collect()}
    sizes = {}
    for r in rows.collect():
        prefix = (r.key & (1 << 64) - 1) >> 58
        depth = lines[prefix]
        sizes[depth, prefix >> 6 - depth] = sizes.get((depth, prefix >> 6 - depth), 0) + 1
    assert max(sizes.values()) <= 100 and min(d for d, _ in sizes) >= 3


def test_without_copies_keeps_columns_and_last_rows(messy):
    kept = exact_dedup.without_copies(messy)
    assert kept.columns == messy.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([2, 12, 5, 7, 8, 8, 9, 10, 11, None], key=repr)


def test_empty_tables(messy):
    none = messy.where("false")
    assert exact_dedup.exact_groups(none).count() == 0
    assert simhash.fingerprint_groups(none).count() == 0
    assert simhash.one_of_each_group(none).count() == 0


def test_fingerprint_groups_equal_brute_force(small, small_rows):
    want = brute.simhash_groups(small_rows)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.fingerprint_groups(small).collect()}
    assert got == want


def test_fingerprint_groups_of_messy_rows(messy):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.fingerprint_groups(messy).collect()}
    want = brute.simhash_groups([(d, t) for d, t in TEXTS if d is not None])
    assert {d: v for d, v in got.items() if d is not None} == want
    assert got[3] == got[5] == ("0" * 16, 3)


@pytest.mark.parametrize("bits", [1, 2, 3])
@pytest.mark.parametrize("file_rows", [2, 1000])
def test_links_lose_nothing_also_in_crowded_files(spark, bits, file_rows):
    random.seed(bits)
    marks = set()
    for _ in range(6):
        center = random.getrandbits(64)
        for _ in range(25):
            marks.add(center ^ sum({1 << random.randrange(64) for _ in range(random.randint(0, 5))}))
    signed = sorted(m - (1 << 64) if m >> 63 else m for m in marks)
    df = spark.createDataFrame([(m,) for m in signed], "fp long")
    parts = {m: {m} for m in signed}
    for r in simhash.links(df, bits, file_rows).collect():
        if parts[r.u] is not parts[r.v]:
            parts[r.u] |= parts[r.v]
            for m in parts[r.u]:
                parts[m] = parts[r.u]
    want = {m: {m} for m in signed}
    for a in signed:
        for b in signed:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= bits and want[a] is not want[b]:
                want[a] |= want[b]
                for m in want[a]:
                    want[m] = want[a]
    assert parts == want


def test_ring_passes_every_close_pair_and_prunes_others():
    rng = np.random.default_rng(5)
    differences = rng.multinomial(8, [1 / 16] * 16, size=5000)
    assert simhash.on_ring(differences, 8).all()
    far = rng.multinomial(40, [1 / 16] * 16, size=5000)
    assert simhash.on_ring(far, 8).mean() < 0.05
    lopsided = np.array([[0, 3, 0, 0]])
    assert not simhash.on_ring(lopsided, 2).any()


def _similar(rows, similarity=0.8, k=5):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b:
                shared, both = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                if (both == 0) or shared >= similarity * both and (sets[a] and sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d for d in sets if find(d) == d}


@pytest.mark.parametrize("settings", [{}, {"file_rows": 3}])
def test_similar_groups_equal_brute_force(spark, small_rows, settings):
    random.seed(3)
    rows = [(d, t) for d, t in small_rows]
    base = [t for _, t in small_rows if t and 150 < len(t.split()) < 400][:6]
    for n, text in enumerate(base):
        for c in range(8):  # copies on both sides of the limit
            words = text.split()
            for _ in range(1 + c):
                words[random.randrange(len(words))] = f"w{random.randrange(10**6)}"
            rows.append((10_000 + 100 * n + c, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.similar_groups(docs, **settings).select("keep_id").distinct()
    assert {r.keep_id for r in kept.collect()} == _similar(rows)


def test_one_of_each_group_keeps_rows_without_id(messy):
    kept = simhash.one_of_each_group(messy)
    assert kept.columns == messy.columns
    # rows without words are one group; repeated rows stay together
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 6, 8, 8, 9, 10, None], key=repr)


def test_similar_sets_alone_decide_in_short_texts(spark):
    """Of 8 words inside 9 (4 shingles of 5) and of texts that share 7 shingles of 9 the estimates err both ways."""
    rows = []
    for n in range(1500):
        words = [f"w{n}x{i}" for i in range(9)]
        rows.append((4 * n, " ".join(words)))
        rows.append((4 * n + 1, " ".join(words[:8])))
        seven = [f"v{n}x{i}" for i in range(13)]
        rows.append((4 * n + 2, " ".join(seven[:12])))  # 8 shingles
        rows.append((4 * n + 3, " ".join([*seven[:11], "other"])))  # shares 7 of 9
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.keep_id for r in simhash.similar_groups(docs).select("keep_id").distinct().collect()}
    assert kept == {4 * n + k for n in range(1500) for k in (0, 2, 3)}


def test_near_fingerprints_alone_find_similar_texts(spark, monkeypatch):
    """Without any band in common: the fingerprints' search brings long texts together, and their sets link them."""
    monkeypatch.setattr(simhash, "band_keys", lambda s: np.array([int(s.sum() >> np.uint64(1))], dtype=np.int64))
    words = [f"w{i}" for i in range(4_000)]
    texts = [" ".join(words), " ".join([*words, "more"]), " ".join(reversed(words)), " ".join([*words[:2_000], *words[2_001:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = {simhash.set_fingerprint(s) for s in token_sets(pa.array(texts[:2]), 5)}
    assert max(bin((a ^ b) & (2**64 - 1)).count("1") for a in prints for b in prints) <= 2
    kept = {r.doc_id for r in simhash.one_of_each_group(docs).collect()}
    assert 1 not in kept and {0, 2} <= kept


def test_similar_texts_share_a_file():
    """With 14 bands 0.06% of such pairs would share none."""
    rng = np.random.default_rng(9)
    for _ in range(20_000):
        shingles = rng.integers(0, 2**64, 5, dtype=np.uint64)
        assert (simhash.band_keys(shingles) == simhash.band_keys(shingles[:4])).any()


def test_shipped_sets_grow_with_the_group(spark, monkeypatch):
    """Of a group of near copies four times as large, four times the sets are shipped, whatever the pieces."""
    random.seed(6)
    base = [f"w{i}" for i in range(60)]
    shipped = {}
    for size in (300, 1200):
        texts = []
        for _ in range(size):
            words = list(base)
            words[random.randrange(60)] = f"x{random.randrange(10**6)}"
            texts.append(" ".join(words))
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        asked = []
        elements_of = simhash.elements_of

        def counted(*args):
            sets = elements_of(*args)

            def of(marks):
                asked.append(marks.count())
                return sets(marks)

            return of

        monkeypatch.setattr(simhash, "elements_of", counted)
        groups = simhash.similar_groups(docs, file_rows=50)
        assert groups.select("keep_id").distinct().count() == len(_similar(list(enumerate(texts)))) if size == 300 else True
        monkeypatch.setattr(simhash, "elements_of", elements_of)
        shipped[size] = sum(asked)
    assert shipped[1200] <= 5 * max(shipped[300], 300)
