"""Collocations, source divergences and the n-gram join against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import TEXTS

from tillworks.llm import collocations, divergence, ngram_join, set_links

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


# --- collocations ---------------------------------------------------------------------------------------


def _collocations(rows, least, best):
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for size in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 50 * a for b in longer):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:best], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -score))
    return sorted(found)


def _worded(seed, n):
    draw = random.Random(seed)
    words = ["the", "New", "york", "tax", "ab", "ÀB", "x\x01", "漢", "of", "a"]
    breaks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!"]
    return "".join(draw.choice(words) + draw.choice(breaks) for _ in range(n))


def test_collocations_equal_brute_force(spark):
    rows = [(i, _worded(i, 400), ["en", "de", None, ""][i % 4], "s", 0) for i in range(60)]
    rows += [(100, None, "en", "s", 0), (101, "", None, None, 0), (102, _worded(1, 60), "en", "s", 0), (102, _worded(1, 60), "en", "s", 0)]
    want = _collocations([(r[1], r[2]) for r in rows], 10, 40)
    got = collocations.collocations(_table(spark, rows), best=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_collocations_of_small_batches(spark):
    """Runs that reach over batches of the stream: rare followers are folded, frequent ones kept."""
    rows = [(i, "hot pair w%d. hot pair w%d. hot pair fix" % (i, i % 7), "en", "s", 0) for i in range(200)]
    want = _collocations([(r[1], r[2]) for r in rows], 10, 2000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = sorted(map(tuple, collocations.collocations(_table(spark, rows)).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and len(want) >= 3


def test_collocations_without_hot_parts_and_of_messy_rows(spark, messy, monkeypatch):
    want = _collocations([(t, None) for _, t in TEXTS], 10, 2000)
    assert sorted(map(tuple, collocations.collocations(messy).collect())) == want
    monkeypatch.setattr(collocations, "HOT_SHARE", 2.0)  # every part by merge join
    assert sorted(map(tuple, collocations.collocations(messy).collect())) == want
    assert collocations.collocations(messy.where("false")).count() == 0


def test_scores_beyond_64_bits(spark):
    told = [("en", "x", None, 9_000_000_000, None, 0), ("en", "y", None, 8_000_000_000, None, 0), ("en", None, None, 10**11, None, None)]
    told.append(("en", "x y", None, 7_000_000_000, None, 0))
    rows = spark.createDataFrame(told, collocations._TOLD)
    original, collocations.frequent_phrases = collocations.frequent_phrases, lambda docs, least: rows
    try:
        (row,) = collocations.collocations(rows).collect()
    finally:
        collocations.frequent_phrases = original
    assert row.score == 10**6 * 7_000_000_000**2 // (9_000_000_000 * 8_000_000_000)


# --- divergences ----------------------------------------------------------------------------------------


def _divergences(rows, ranks=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    found = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        v = len(kept)
        of = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        of[None] = {t: sum(of[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v) for t in kept} for s, c in of.items()}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in sources if o != s]
            own = [t for t in kept if of[s][t] and p[s][t] > p[None][t]]
            terms = [(-((p[s][t] - p[None][t]) ** 2 // p[None][t]), t.encode(), t) for t in own]
            for part, values in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                found += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(values, 1)]
    return sorted(found)


@pytest.mark.parametrize("settings", [{}, {"TILE": 2, "SHARD_CELLS": 7}])
def test_divergences_equal_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(divergence, name, value)
    rows = [(i, _worded(i, 30), ["en", "de", None][i % 3], "src%d" % (i % 5), 0) for i in range(90)]
    rows += [(200, "single words only here", "xx", "a", 0), (201, None, "xx", "b", 0), (202, "12 34", "de", None, 0), (202, "12 34", "de", None, 0)]
    want = _divergences([(r[1], r[2], r[3]) for r in rows])
    assert sorted(map(tuple, divergence.divergences(_table(spark, rows)).collect())) == want
    assert {r[0] for r in want} == {"en", "de", "", "xx"}


def test_divergences_of_messy_rows_and_empty_tables(messy):
    want = _divergences([(t, "k" and None, None) for _, t in TEXTS])
    assert sorted(map(tuple, divergence.divergences(messy).collect())) == want
    assert divergence.divergences(messy.where("false")).count() == 0


def test_sums_of_a_shard_equal_the_plain_sums():
    draw = np.random.default_rng(3)
    zero = draw.integers(1, 50, 6)
    matrix = np.where(draw.random((40, 6)) < 0.3, draw.integers(50, 10**9, (40, 6)), zero)
    rows, columns = np.nonzero(matrix != zero)
    rows = np.unique(rows, return_inverse=True)[1]
    matrix = matrix[(matrix != zero).any(axis=1)]
    own = np.array([1, 4])
    plain = np.stack([((matrix[:, g : g + 1] - matrix) ** 2 // matrix).sum(axis=0) for g in own])
    assert (divergence._pair_sums(own, zero, rows, columns, matrix[matrix != zero]) == plain).all()


# --- the join -------------------------------------------------------------------------------------------


def _shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def _parts(rows, words=4, percent=85):
    sets = [_shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    first = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            first[find(i)] = min(d, first.get(find(i), d))
    return sorted(((d, len(s), first.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def _near_texts(seed, bases, versions, size):
    """Versions of some texts with more and more words changed, and a passage that many texts share."""
    draw = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    passage = [draw.choice(vocabulary) for _ in range(size // 2)]
    texts = []
    for _ in range(bases):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(size // 2, size * 2))]
        at = draw.randrange(len(base))
        base[at:at] = passage
        for v in range(versions):
            words = list(base)
            for _ in range(v * len(words) // 100):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("percent, words, file_rows, few, small", [(85, 4, 4000, 32, 4), (85, 4, 3, 0, 0), (80, 5, 5, 2, 1)])
def test_join_equals_brute_force(spark, monkeypatch, percent, words, file_rows, few, small):
    monkeypatch.setattr(set_links, "FEW", few)
    monkeypatch.setattr(set_links, "SMALL", small)
    texts = _near_texts(percent + file_rows, 12, 9, 80) + _near_texts(1, 20, 6, 8) + ["one two", "ONE two", "one", "", None, "a b c d", "a b c d e", " \n "]
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "only here"), (1000, texts[0])]
    docs = _table(spark, [(d, t, None, None, 0) for d, t in rows])
    got = ngram_join.joined_documents(docs, words, percent, file_rows)
    want = _parts(rows, words, percent)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert 5 < len({c for _, _, c in want}) < len(rows) - 30


def test_open_files_come_once_with_their_size(spark):
    """Of files with the same members the first one; none whose members have one label."""
    files = {1: "abc", 2: "abc", 3: "ab", 4: "cd", 5: "abcd", 6: "dcba"}
    rows = [(f, m.encode(), b"x" if m in "ab" else m.encode()) for f, members in files.items() for m in members]
    got = set_links._one_each(spark.createDataFrame(rows, "file long, mark binary, label binary")).collect()
    assert sorted((r.file, bytes(r.mark).decode(), r["size"]) for r in got) == sorted((f, m, len(files[f])) for f in (1, 4, 5) for m in files[f])


@pytest.mark.parametrize("file_rows", [5, 4000])
def test_members_of_a_file_meet_its_size_once(spark, monkeypatch, file_rows):
    """Units are cut from stored rows; a join left in them would run for each frame that is built on it."""
    plans, dealt = [], set_links.dealt

    def seen(rows, most):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return dealt(rows, most)

    monkeypatch.setattr(set_links, "dealt", seen)
    texts = _near_texts(4, 6, 9, 60)
    docs = _table(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)])
    got = ngram_join.joined_documents(docs, 4, 85, file_rows)
    assert sorted(map(tuple, got.collect()), key=repr) == _parts(list(enumerate(texts)))
    assert plans and not any("Join" in p or "Aggregate" in p for p in plans)


def test_join_of_messy_rows_and_empty_tables(messy):
    assert sorted(map(tuple, ngram_join.joined_documents(messy).collect()), key=repr) == _parts(TEXTS)
    assert ngram_join.joined_documents(messy.where("false")).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.3, 0.7, 1.0])
def test_similar_sets_share_a_key(share):
    """Whatever tokens are frequent, two sets that are similar enough have a key in common."""
    draw = np.random.default_rng(int(share * 10))
    classes = (draw.random(ngram_join.SLOTS) < share).astype(np.uint8)
    for trial in range(400):
        percent = (80, 85, 95)[trial % 3]
        n = int(draw.integers(1, 200))
        a = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        gone = int(draw.integers(0, n * (100 - percent) // 100 + 1))
        b = np.unique(np.concatenate([a[draw.permutation(n)[gone:]], draw.integers(0, 2**64, int(draw.integers(0, 3)), dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if np.array_equal(a, b) or not set_links.similar(np.int64(shared), np.int64(len(a)), len(b), percent):
            continue
        keys = [set(ngram_join.index_keys(x, classes, percent)[0].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_tokens_depend_on_the_words_only():
    texts = ["A b c d e", " a\tB  c d\n e ", "x a b c d", "a b c", "a b", ""]
    sets = [set(s.tolist()) for s in ngram_join.token_sets(pa.array(texts), 4)]
    assert sets[0] == sets[1] and len(sets[0]) == 2 and len(sets[0] & sets[2]) == 1
    assert len(sets[3]) == len(sets[4]) == 1 and sets[3] != sets[4] and not sets[5]


def test_histograms_pass_over_no_similar_pair():
    draw = np.random.default_rng(9)
    sizes = [5, 900, 1024, 1025, 1200, 2047, 2100, 5000, 9000]
    sets = [np.unique(draw.integers(0, 2**64, n, dtype=np.uint64)) for n in sizes]
    near = [np.concatenate([s[: int(len(s) * 0.93)], draw.integers(0, 2**64, int(len(s) * 0.05), dtype=np.uint64)]) for s in sets]
    every = [*sets, *[np.unique(x) for x in near]]
    rows = pa.table({
        "n": [len(x) for x in every],
        "side": [0] * len(every),
        "label": pa.array([bytes([i]) for i in range(len(every))]),
        "ranges": pa.array([set_links.histogram(x) for x in every], pa.binary()),
    })
    unit = set_links._Unit(rows, 85)
    order = np.argsort([len(x) for x in every], kind="stable")
    ranked = [every[i] for i in order]
    for i, a in enumerate(ranked):
        assert len(a) == unit.sizes[i]
        found = set(unit.partners(i, unit.labels).tolist())
        close = {j for j, b in enumerate(ranked) if j != i and set_links.similar(len(np.intersect1d(a, b)), np.int64(len(a)), len(b), 85)}
        assert close <= found and (len(a) < 100 or len(found) <= len(close) + 1)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_shared_files_over_batches(size):
    draw = random.Random(size)
    rows = sorted((draw.randrange(12), draw.choice([0, 0, 0, 3]), bytes([draw.randrange(4)]) * 16) for _ in range(80))
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))], names=["file", "salt", "mark"])
    got = [tuple(r.values()) for b in ngram_join._shared(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    want = set()
    for file, salt in {r[:2] for r in rows}:
        marks = sorted({m for f, s, m in rows if (f, s) == (file, salt)})
        if len(marks) > 1 or salt:
            want |= {(file, salt, m, marks[0]) for m in marks}
    assert len(got) == len(set(got)) and set(got) == want
