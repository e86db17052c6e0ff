"""Personal data, toxicity, url filters and licences."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from pathlib import Path

import pytest
from brute_pii import base
from conftest import TEXTS

from tillworks.llm import license_scan, pii, toxicity, url_rules

PARTS = [
    "a", "b.c", "x@y.z", "@", ".", "..", "_", "%", "+1 555 123 4567", "+1", "(555)", "-", " ", "192.168.0.1", "256.1.1.1",
    "001.002.003.004", "1.2.3.4.5", "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "0", "99", "é", "😀", "\n", "mail-8.example.com",
]


def test_base_spans_equal_brute_force(spark):
    random.seed(2)
    texts = [t for _, t in TEXTS] + ["".join(random.choices(PARTS, k=random.randint(1, 12))) for _ in range(1500)]
    texts += ["1" * 50_000, "a" * 50_000 + "@", "a@b" + ".c" * 20_000, "+1" + "(" * 50_000, "1." * 30_000, "9 " * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.personal_data(docs).collect():
        found = base(texts[row.doc_id] or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert row.base_sha256 == hashlib.sha256(told.encode()).hexdigest(), texts[row.doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == x for k, _, _ in found) for x in pii.BASE]
        assert set(told.split(",")) - {""} <= set(row.spans.split(","))


def test_method_adds_what_the_labelers_agree_on(spark):
    texts = [
        "My social security number, ssn 123-45-6789, is here.",
        "Please transfer to the iban DE89370400440532013000 today.",
        "You can call 555-234-5678 after six.",
        "Yours, Dr. Mary Smith Jones",
        "The token 123-45-6789 is an order id.",
        "A part ABCD12345678901234 of the version key.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert [spans[i].split(":")[0] for i in range(4)] == ["ssn", "iban", "local_phone", "name"]
    assert spans[0] == "ssn:31:42" and spans[4] == spans[5] == ""


def test_estimation_finds_the_reliable_labelers():
    lines, random_state = {}, random.Random(4)
    for _ in range(4000):
        personal = random_state.random() < 0.4
        vote = {x: (1 if random_state.random() < (right if personal else 1 - right) else -1) for x, right in zip(pii.LABELERS, (0.95, 0.8, 0.6))}
        key = (4, *vote.values(), 1)
        lines[key] = lines.get(key, 0) + 1
    counted = [dict(zip(pii.FEATURES, key)) | {"n": n} for key, n in sorted(lines.items())]
    chances, personal, _ = pii.estimated(counted)
    assert abs(personal - 0.4) < 0.1
    assert chances["pattern"][0] - chances["pattern"][1] > chances["context"][0] - chances["context"][1]


def test_masked_texts(messy):
    rows = {r.doc_id: r for r in pii.without_personal_data(messy).collect()}
    assert pii.without_personal_data(messy).columns == messy.columns
    assert rows[1].text == "The first text of all, with a mail to [EMAIL] in it." and rows[1].n_chars == len(rows[1].text)
    assert rows[10].text == "Call [PHONE] or [IP] or [CARD]."
    assert rows[3].text is None and rows[4].text == "" and rows[9].text == dict(TEXTS)[9]
    none = messy.where("false")
    assert pii.personal_data(none).count() == 0 and pii.without_personal_data(none).count() == 0


def _masked(text: str, spans: str) -> str:
    found = sorted((int(a), pii.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in spans.split(",") if x))
    made, at = "", 0
    for start, kind, end in found:
        if start >= at:
            made += text[at:start] + f"[{pii.KINDS[kind].upper()}]"
        at = max(at, end)
    return made + text[at:]


def test_masked_texts_equal_the_spans(spark, small):
    """Texts longer than a chunk, overlapping kinds, spans at chunk borders."""
    random.seed(8)
    more = [*PARTS, "ssn 123-45-6789", "iban DE89370400440532013000", "call 555-234-5678", "Dr. Mary Smith", "word " * 11]
    texts = ["".join(random.choices(more, k=random.choice([5, 40, 900]))) for _ in range(150)]
    docs = small.select("doc_id", "text", "n_chars").unionByName(
        spark.createDataFrame([(10**6 + i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    )
    spans = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.without_personal_data(docs).collect()
    assert len(rows) == len(texts) and sum(bool(x) for x in spans.values()) > 50
    for r in rows:
        assert r.text == _masked(texts[r.doc_id] or "", spans[r.doc_id]) or texts[r.doc_id] is None
        assert r.text is None or r.n_chars == len(r.text)


def test_candidates_never_overlap(spark):
    random.seed(9)
    more = ["123-45-6789", "DE89370400440532013000", "555-234-5678", "Mary Smith", "Dr. Jane Doe Roe", "1.2.3.4", "+1 555 123 4567", " ", "-", "a@b.c"]
    texts = ["".join(random.choices(more, k=k)) for k in [3] * 300 + [700] * 3]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.with_candidates(pii.with_base(frame)).collect():
        found = sorted((s.start, s.end) for s in row.candidates)
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
        assert not any(s.start < t.end and t.start < s.end for s in row.candidates for t in row.base)


def test_work_grows_with_the_length_of_a_text(spark):
    """100,000 spans in one text: sums, overlaps, cues and masks in proportion to it."""
    text = "1.2.3.4 call 555-234-5678 " * 50_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begun = time.monotonic()
    (found,) = pii.personal_data(docs).collect()
    (row,) = pii.without_personal_data(docs).collect()
    assert found.n_ip == 50_000 and found.spans.count(",") == 99_999
    assert row.text == "[IP] call [LOCAL_PHONE] " * 50_000
    assert time.monotonic() - begun < 120


def test_messy_rows_keep_their_number(messy):
    rows = pii.personal_data(messy).collect()
    assert sorted((r.doc_id is None, r.n_email) for r in rows) == sorted((d is None, len(base(t or "")) * ("@" in (t or ""))) for d, t in TEXTS)


# --- toxicity -------------------------------------------------------------------------------------------


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    random.seed(8)
    terms = sorted({"".join(random.choices("abc", k=random.randint(4, 8))) for _ in range(40)})
    lexicon = toxicity.Lexicon(terms, [])
    for _ in range(4000):
        word = "".join(random.choices("abcd", k=random.randint(1, 9)))
        close = [t for t in terms if _distance(word, t) <= 1 and len(t) >= 5 and t[:1] == word[:1]]
        want = (word, "term") if word in terms else (min(close), "misspelled") if close else None
        assert lexicon.find(word) == want, word


def test_neighbours_are_looked_up_beside_matches_only(monkeypatch):
    looked = []

    class Counting:
        findall = staticmethod(lambda s, real=toxicity._WORD.findall: (looked.append(s), real(s))[1])

    matcher = toxicity.Matcher(toxicity.Lexicon(["idiot"], []))
    text = "plain " * 500 + 'he said "idiot" \u2028 idiots,  idiot' + " plain" * 500
    expected = matcher.matches(text)
    monkeypatch.setattr(toxicity, "_WORD", Counting)
    assert matcher.matches(text) == expected
    assert expected == {("idiot", "term", True): 2, ("idiot", "misspelled", True): 1}
    assert len(looked) < 60


def test_stems_and_quotations():
    matcher = toxicity.Matcher(toxicity.Lexicon(["idiot"], ["vequ"]))
    assert matcher.matches("You are an IDIOT, really") == {("idiot", "term", False): 1}
    assert matcher.matches('They wrote "idiot" on the wall') == {("idiot", "term", True): 1}
    assert matcher.matches("the word idiot is old") == {("idiot", "term", True): 1}
    assert matcher.matches("an 1diot and an id1ot, an idiott") == {("idiot", "misspelled", False): 2}
    assert matcher.matches("vequaire") == {("vequ", "stem", False): 1}
    assert matcher.matches("") == matcher.matches("veq ido lidiot") == {}


def test_whole_automaton_equals_edit_distance():
    random.seed(18)
    terms = sorted({"".join(random.choices("abc", k=random.randint(4, 8))) for _ in range(25)})
    stems = ["dabc", "dcca", *sorted({"d" + "".join(random.choices("abc", k=random.randint(4, 6))) for _ in range(4)})]
    stems = [s for s in stems if not any(s != o and s.startswith(o) for o in stems)]
    under = [s + "".join(random.choices("abcd", k=3)) for s in stems]
    lexicon = toxicity.Lexicon(terms, stems, stem_words=under, weak=frozenset(toxicity.WEAK))
    sorts = set()
    for _ in range(6000):
        word = "".join(random.choices("abcd", k=random.randint(1, 9)))
        if random.random() < 0.5:
            word = random.choice([*terms, *stems, *under])
            at = random.randrange(len(word))
            word = word[:at] + random.choice(["", "a", "d", "x" + word[at]]) + word[at + 1 :] + random.choice(["", "", "b"])
        near = lambda entries: [e for e in entries if _distance(word, e) <= 1 and len(e) >= 5]
        begun = [s for s in stems if word.startswith(s)]
        begins = [s for s in stems if any(_distance(word[:k], s) <= 1 for k in range(1, len(word) + 1))]
        longest = max(begins, key=lambda s: (len(s), s), default="")
        if word in terms:
            want = word, "term"
        elif begun:
            want = max(begun, key=len), "stem"
        elif same := [t for t in near(terms) if t[:1] == word[:1]]:
            want = min(same), "misspelled"
        elif near(terms):
            want = min(near(terms)), "first letter"
        elif near(under):
            want = min(near(under)), "stem word"
        else:
            want = (longest, "near stem" if len(longest) >= 5 else "near short stem") if longest else None
        assert lexicon.find(word) == want, word
        sorts.add(want and want[1])
    assert sorts >= {*toxicity.WEAK, "misspelled", "stem", "term", None}


def test_first_letters_and_stems_may_be_misspelled(spark, taught):
    docs, labels = taught
    filler = "lorem nisi tales mirum solet "
    texts = ["xorgel", "orgel", "azorgel", "ubbit", "gtaghment", "zorgel", "graghment"]
    asked = spark.createDataFrame([(i, filler + t + " toma rent") for i, t in enumerate(texts)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(asked, labels, taught_by=docs).collect()}
    assert all(scores[i] > 0.5 for i in range(len(texts))), scores
    # where a plain word is as near, the texts with it weigh against the match
    common = docs.withColumn("text", toxicity.F.when(toxicity.F.col("doc_id") % 3 == 1, toxicity.F.concat("text", toxicity.F.lit(" orgel"))).otherwise(toxicity.F.col("text")))
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(asked, labels, taught_by=common).collect()}
    assert scores[1] < 0.1 and scores[5] > 0.7


@pytest.fixture(scope="module")
def taught(spark):
    """600 texts; every third is toxic by one of four terms or by words with a common beginning."""
    random.seed(6)
    rows, labels = [], []
    for i in range(900):
        words = ["".join(random.choices("aeioulmnrst", k=random.randint(3, 7))) for _ in range(60)]
        toxic = i % 3 == 0
        if toxic:
            ends = ["aire", "ique", "ment", "eur", "oir", "ance", "ons", "ez"]
            words[random.randrange(60)] = random.choice(["zorgel", "wubbit", "krandy", "flonky", "gragh" + random.choice(ends)])
        rows.append((i, " ".join(words)))
        if i < 800:
            labels.append((i, None, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")


def test_held_out_texts_are_told_apart(taught):
    docs, labels = taught
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in rows if r.held_out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_held_out_labels_teach_nothing(taught):
    docs, labels = taught
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    want = sorted(map(tuple, toxicity.toxicity_scores(docs, labels).collect()))
    assert sorted(map(tuple, toxicity.toxicity_scores(docs, turned).collect())) == want


def test_toxicity_of_messy_rows(messy, taught):
    docs, labels = taught
    rows = toxicity.toxicity_scores(messy, labels, taught_by=docs).collect()
    assert len(rows) == len(TEXTS) and not any(r.predicted for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    kept = toxicity.without_toxic(messy, labels, taught_by=docs)
    assert kept.columns == messy.columns and kept.count() == len(TEXTS)
    unlabelled = toxicity.toxicity_scores(messy, labels.where("false")).collect()
    assert len(unlabelled) == len(TEXTS) and not any(r.predicted for r in unlabelled)
    assert toxicity.toxicity_scores(messy.where("false"), labels).count() == 0


# --- urls -----------------------------------------------------------------------------------------------

URLS = [
    "http://a.example.net/en/1", "https://Example.NET/de/1", "http://x.org/fr/", "http://x.org/fr", "ftp://example.com/de/?q=/en/",
    "http://net/en", "http://net", "http://subnet/", "http://a.example.com/DE/1", "http://a.example.com/de#x", None, "", "no scheme/net/",
    "http://b.example.net?x=1", "http://b.example.net#/en/", "http://c.example.net/en/x?u=http://y.org/fr/", "://example.com/de/x", "http://www.EXAMPLE.com/de/é",
]


def _judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [r for r in url_rules.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_listed_rules_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    rows = {r.page_id: r for r in url_rules.url_verdicts(pages).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = _judged(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), url
        assert rows[i].verdict == verdict or verdict is None and rows[i].verdict in ("allow", "block")
    assert url_rules.url_verdicts(pages.where("false")).count() == 0


def test_mined_rules_equal_brute_force(spark):
    from itertools import combinations

    random.seed(9)
    sets = [sorted(random.sample(["a", "b", "c", "d", "e"], k=random.randint(1, 4))) for _ in range(300)]
    rows = [(s, "block" if {"a", "b"} <= set(s) or s == ["c"] else "allow") for s in sets]
    got = url_rules.mined_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.02, 0.9)
    got = {(tuple(r.rule_tokens), r.verdict): round(r.confidence, 6) for r in got.collect()}
    all_rules = {}
    for n in range(1, 6):
        for some in combinations("abcde", n):
            met = [v for s, v in rows if set(some) <= set(s)]
            for verdict in ("allow", "block"):
                hits = met.count(verdict)
                if hits >= 0.02 * len(rows) and hits >= 0.9 * len(met):
                    all_rules[some, verdict] = round(hits / len(met), 6)
    want = {
        (some, verdict): c
        for (some, verdict), c in all_rules.items()
        if not any(all_rules.get((tuple(x for x in some if x != one), verdict), -1) >= c for one in some)
    }
    assert got == want and want


def test_mined_verdicts_follow_the_best_rule(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    told = url_rules.judged(pages)
    rules = url_rules.mined_rules(told.where("verdict is not null").select("tokens", "verdict")).collect()
    verdicts = {r.page_id: r.verdict for r in url_rules.url_verdicts(pages).collect()}
    for row in told.where("verdict is null").collect():
        fits = [r for r in rules if set(r.rule_tokens) <= set(row.tokens)]
        best = max(fits, key=lambda r: (r.confidence, r.support, len(r.rule_tokens), " ".join(r.rule_tokens)), default=None)
        assert verdicts[row.page_id] == (best.verdict if best else "allow")


# --- licences -------------------------------------------------------------------------------------------


def test_equivalent_spellings_have_one_digest(spark):
    mit = dict((n, t) for n, t in reversed(license_scan.KNOWN) if n == "MIT")["MIT"]
    texts = [
        "Copyright (c) 2001 Jo Doe\n\n" + mit,
        mit.upper().replace("SUBLICENSE", "SUB-LICENCE").replace("NONINFRINGEMENT", "NON-INFRINGEMENT"),
        "\n© 1999, 2001 A\nCopyright 2003 B\n" + mit.replace(" ", "\n  "),
        mit + " And more.",
        "Some prose.\nReleased under the MIT Licence\nLicensed under cc by-nc 4.0\nthe license of nothing",
        None,
        "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.license_scan(docs).collect()}
    assert [rows[i].license for i in range(7)] == ["MIT"] * 3 + [None] * 4
    assert rows[0].canonical_sha256 == rows[1].canonical_sha256 == rows[2].canonical_sha256
    assert rows[4].line_licenses == "CC-BY-NC-4.0,MIT" and rows[5].line_licenses == rows[6].line_licenses == ""
    assert license_scan.license_scan(docs.where("false")).count() == 0


def test_license_scan_of_messy_rows(messy):
    assert license_scan.license_scan(messy).count() == len(TEXTS)


def test_complete_texts_of_short_licenses(spark):
    import textwrap

    whole = [(name, text) for name, text in license_scan.KNOWN if len(text) > 400]
    texts = [f"Copyright (c) 2020, Somebody\n\n{textwrap.fill(text, 70)}\n" for _, text in whole]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.license for r in license_scan.license_scan(docs).collect()} == dict(enumerate(n for n, _ in whole))
    assert {n for n, _ in whole} == {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "Unlicense", "Apache-2.0"}


def _installed(least: int = 20) -> list[tuple[str, str]]:
    """Whole MIT and BSD files as they stand in installed packages, and which of the two they are."""
    import pyspark

    folders = [Path(pyspark.__file__).parent / "licenses", *Path(pyspark.__file__).parents[1].glob("*.dist-info")]
    texts = set()
    for file in (f for folder in folders for f in folder.rglob("*") if re.match("(?i)licen[sc]e|copying", f.name) and f.is_file()):
        text = file.read_text(errors="replace")
        plain = " ".join(text.lower().split())
        if len(plain) < 1200 and "permission is hereby granted, free of charge" in plain and "noninfringement" in plain:
            texts.add(("MIT", text))
        if len(plain) < 1700 and "redistribution and use in source and binary forms" in plain:
            texts.add(("BSD", text))
    if len(texts) < least:
        pytest.skip("too few packages are installed here")
    return sorted(texts)


def test_real_files_are_found(spark):
    """Titles, reserved rights, copyright lines without a year, named holders, other wrapping and bullets."""
    files = _installed()
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(files)], "doc_id long, text string")
    found = {r.doc_id: r.license or "" for r in license_scan.license_scan(docs).collect()}
    hits = [found[i].startswith(kind) for i, (kind, _) in enumerate(files)]
    assert sum(hits) >= 20 and sum(hits) >= 0.9 * len(hits), [files[i][1][:80] for i, hit in enumerate(hits) if not hit]


def test_other_terms_are_no_licence(spark):
    mit = next(t for n, t in license_scan.KNOWN if n == "MIT")
    texts = [mit + " You shall not use it on Sundays.", mit.replace("without restriction", "with restriction"), "The MIT License\n\nCopyright Jo\n" + mit]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.license for r in license_scan.license_scan(docs).orderBy("doc_id").collect()] == [None, None, "MIT"]


def test_passages_in_common_make_no_copies(spark):
    """Texts that share a third keep teaching, near copies with one label teach once."""
    draw = random.Random(5)
    words = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    passage, base = words(40), words(120)
    near = [" ".join([*base[:k], "new", *base[k + 1 :]]) for k in range(0, 120, 12)]
    other = [" ".join([*words(40), *passage, *words(40)]) for _ in range(60)]
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 != 1][:70]
    docs = spark.createDataFrame(list(zip(ids, near + other)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in ids], "doc_id long, toxic int")
    taught = [r.text for r in toxicity.training_texts(docs, labels).collect()]
    assert len(set(taught) & set(near)) <= 3 and len(set(taught) & set(other)) >= 55
