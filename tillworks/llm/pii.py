"""Personal data by weak supervision, in DataFrame functions only.

*Base spans.* Email addresses, ip addresses, card and phone numbers by their patterns and checks. They always stay.

*Candidates.* A wider pattern marks what may be personal too: social security numbers, IBANs, phone numbers
without a country code, and names behind a title or a common given name. A candidate that overlaps a base span is left out.

*Labelers.* Three of them vote yes, no or nothing on every span: the strict pattern of its kind, a gazetteer (given names,
countries with IBANs, assigned number ranges, address endings), and the words right before it. Base spans vote too;
they are known to be personal.

*Reliabilities.* The spans are counted by kind and votes: a few dozen lines for any number of documents. From these
expectation-maximisation estimates how often each labeler is right on personal and on other spans, starting from
and held to prior beliefs that count as ``PRIOR_WEIGHT`` spans.

*Classifier.* The posterior of a candidate under the estimates is the target of a final classifier over kind, votes and length
class (naive Bayes over the weighted counts); candidates of at least ``THRESHOLD`` become spans.

Positions are code points. A null text is the empty one; repeated rows get the same spans; an empty table gives no rows.
Patterns are written so that they neither go back over long runs nor recurse: texts of any length are read once per
pattern.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import whole_texts
from tillworks.session import stored

KINDS = ["email", "ip", "card", "phone", "ssn", "iban", "local_phone", "name"]
BASE = KINDS[:4]

# Possessive forms of the contract's patterns: nothing follows that a shorter match could help. Each begins where the
# run of characters that it can begin with begins, or where the last match has ended (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Titles and common given names, words around personal data and around other numbers, IBAN countries.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora".split()
GIVEN_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica"
    " Thomas Sarah Hans Peter Klaus Anna Ursula Jean Marie Pierre Sophie Jose Maria Carlos Carmen Juan Ana"
).split()
CUES = "phone tel call mobile fax contact email mail ssn social security iban account name born passport telefon konto teléfono".split()
OTHER_CUES = "version isbn page order invoice item part token password key sha hash id seed".split()
IBAN_COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split()

PATTERNS |= {
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "name": r"\b(?:(?:TITLES)\.?\x20[\p{Lu}][\p{Ll}]{1,30}|(?:GIVEN)(?:\x20[\p{Lu}][\p{Ll}]{1,30}))(?:\x20[\p{Lu}][\p{Ll}]{1,30})?\b".replace(
        "TITLES", "|".join(TITLES)
    ).replace("GIVEN", "|".join(GIVEN_NAMES)),
}

#: What a text has to hold for a pattern to be worth a try.
HINTS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]",
    "ssn": "[0-9]-[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}[A-Z0-9]",
    "local_phone": r"[0-9]{3}[\x20.-][0-9]{4}",
    "name": rf"\b(?:{'|'.join([*TITLES, *GIVEN_NAMES])})\b",
}

LABELERS = ["pattern", "gazetteer", "context"]
PRIOR_WEIGHT = 20.0
#: Prior chances of a yes (among yes and no) on personal and on other spans, by labeler; and of a span being personal.
PRIORS = {"pattern": (0.9, 0.3), "gazetteer": (0.8, 0.2), "context": (0.9, 0.1)}
PRIOR_PERSONAL = 0.5
THRESHOLD = 0.8
ROUNDS = 50
BEFORE = 30


# --- spans of one text, as columns ----------------------------------------------------------------------


_PLACED = "array<struct<start:int,end:int,value:string>>"
# A running total of an array is taken slice by slice, and a text is cut from chunks: work in proportion to both, however
# many matches one text holds.
_SLICE, _CHUNK, _CHUNKS = 256, 256, 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where the body has lambdas over arrays."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(items: Column, value: Callable[[Column], Column], op: Callable[[Column, Column], Column]) -> Column:
    """For each item, ``op`` over 0 and the values of all items before it."""

    def part(xs: Column, i: Column) -> Column:
        return F.slice(xs, i * _SLICE + 1, F.lit(_SLICE))

    def of(xs: Column) -> Column:
        slices = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _SLICE).cast("int"))
        totals = F.transform(slices, lambda i: F.aggregate(part(xs, i), F.lit(0), lambda t, x: op(t, value(x))))

        def inside(i: Column, start: Column) -> Column:
            begun = F.struct(start.alias("at"), F.array().cast("array<int>").alias("before"))
            add = lambda t, x: F.struct(op(t["at"], value(x)).alias("at"), F.concat(t["before"], F.array(t["at"])).alias("before"))
            return F.aggregate(part(xs, i), begun, add, lambda t: t["before"])

        def from_totals(t: Column) -> Column:
            starts = F.transform(slices, lambda i: F.aggregate(F.slice(t, F.lit(1), i), F.lit(0), op))
            return _let(starts, lambda s: F.flatten(F.transform(slices, lambda i: inside(i, F.get(s, i)))))

        return F.when(F.size(xs) == 0, F.array().cast("array<int>")).otherwise(_let(totals, from_totals))

    return _let(items, of)


def _largest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _chunked(text: Column) -> Column:
    """The text in chunks of equal length."""
    long = _CHUNK * _CHUNKS
    upto = lambda t, size: F.sequence(F.lit(0), F.floor(F.greatest(F.length(t) - 1, F.lit(0)) / size).cast("int"))
    chunks = lambda b: F.transform(upto(b, _CHUNK), lambda j: F.substring(b, j * _CHUNK + 1, F.lit(_CHUNK)))
    return F.flatten(F.transform(upto(text, long), lambda i: _let(F.substring(text, i * long + 1, F.lit(long)), chunks)))


def _cut(chunks: Column, start: Column, end: Column) -> Column:
    """The text from start to end (exclusive)."""
    first = F.floor(start / _CHUNK).cast("int")
    count = F.floor((end - 1) / _CHUNK).cast("int") - first + 1
    held = F.array_join(F.slice(chunks, first + 1, F.greatest(count, F.lit(0))), "")
    return F.when(end > start, F.substring(held, start % _CHUNK + 1, end - start)).otherwise(F.lit(""))


def _placed(text: Column, kind: str) -> Column:
    """All leftmost matches of a kind, one after the other: array of (start, end, value), code points, end exclusive.

    Splitting by the pattern gives what lies before each match; the running sum of both lengths gives the places.
    """
    pattern = PATTERNS[kind]
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    ahead = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    matches = F.filter(ahead, lambda x: x["m"].isNotNull())  # behind the last match there is a gap only

    def place(x: Column, at: Column) -> Column:
        start = at + x["g"]
        return F.struct(start.alias("start"), (start + F.length(x["m"])).alias("end"), x["m"].alias("value"))

    sums = lambda xs: _before(xs, lambda x: x["g"] + F.length(x["m"]), lambda t, n: t + n)
    found = _let(matches, lambda xs: F.zip_with(xs, sums(xs), place))
    return F.when(text.rlike(HINTS[kind]), found).otherwise(F.array().cast(_PLACED))


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return total + F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _passes(kind: str, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _tagged(kind: str, spans: Column) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), number.alias("kind"), s["end"].alias("end"), s["value"].alias("value"))
    )


def with_base(texts: DataFrame) -> DataFrame:
    """Adds ``base``: the base spans by start, then kind, as an array of (start, kind number, end, value)."""
    each = []
    for kind in BASE:
        each.append(_tagged(kind, F.filter(_placed(F.col("text"), kind), partial(_passes, kind))))
    return texts.withColumn("base", F.array_sort(F.concat(*each)))


def _free_of(spans: Column, taken: Column) -> Column:
    """Spans that overlap none of the taken ones.

    In the order of starts, with the largest end up to each: the last one that starts before a span ends tells all.
    """

    def against(t: Column) -> Column:
        upto = F.zip_with(t, _before(t, lambda x: x["end"], _largest), lambda x, m: F.struct(x["start"].alias("start"), F.greatest(x["end"], m).alias("reach")))

        def halved(r: Column, end: Column) -> Column:
            """How many of ``r`` start before ``end``."""
            begun = F.struct(F.lit(0).alias("lo"), F.size(r).alias("hi"))

            def half(s: Column, _: Column) -> Column:
                middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
                below = F.get(r, middle)["start"] < end
                more = s["lo"] < s["hi"]
                lo = F.when(more & below, middle + 1).otherwise(s["lo"])
                return F.struct(lo.alias("lo"), F.when(more & ~below, middle).otherwise(s["hi"]).alias("hi"))

            return F.aggregate(F.sequence(F.lit(1), F.lit(31)), begun, half, lambda s: s["lo"])

        def free(r: Column) -> Column:
            return F.filter(spans, lambda s: _let(halved(r, s["end"]), lambda n: (n == 0) | (F.get(r, n - 1)["reach"] <= s["start"])))

        return _let(upto, free)

    return F.when((F.size(spans) == 0) | (F.size(taken) == 0), spans).otherwise(_let(F.array_sort(taken), against))


def with_candidates(texts: DataFrame) -> DataFrame:
    """Adds ``candidates``: further spans that may be personal data, none over a base span or an earlier kind's."""
    texts = texts.withColumn("candidates", F.slice("base", F.lit(1), F.lit(0)))
    for kind in KINDS[len(BASE) :]:
        texts = texts.withColumn("placed", _tagged(kind, _placed(F.col("text"), kind)))
        free = _free_of(F.col("placed"), F.concat("base", "candidates"))
        texts = texts.withColumn("candidates", F.concat("candidates", free))
    return texts.drop("placed")


# --- votes ----------------------------------------------------------------------------------------------


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(span: Column, chunks: Column) -> Column:
    """(kind, pattern, gazetteer, context, size class) of a span of a text in chunks."""
    value, kind = span["value"], F.element_at(F.array(*map(F.lit, KINDS)), span["kind"] + 1)
    strict = (
        F.when(kind == "ssn", value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"))
        .when(kind == "iban", value.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$") & value.rlike("[0-9]{6}"))
        .when(kind == "local_phone", value.rlike(r"^\(?[2-9][0-9]{2}\)?[\x20.-]?[2-9]"))
        .when(kind == "name", value.rlike(r"\x20.*\x20") | value.rlike(rf"^(?:{'|'.join(TITLES)})\b"))
        .otherwise(True)
    )
    first = F.regexp_extract(value, r"^\p{L}+", 0)
    in_lists = (
        F.when(kind == "name", F.exists(F.split(value, r"[\x20.]+"), lambda w: w.isin(GIVEN_NAMES)))
        .when(kind == "iban", F.substring(value, 1, 2).isin(IBAN_COUNTRIES))
        .when(kind == "email", value.rlike(r"\.(?:com|org|net|edu|gov|de|fr|es|uk|io)$"))
    )
    before = F.lower(_cut(chunks, F.greatest(span["start"] - BEFORE, F.lit(0)), span["start"]))
    cue, other = before.rlike(rf"\b(?:{'|'.join(CUES)})\b"), before.rlike(rf"\b(?:{'|'.join(OTHER_CUES)})\b")
    size = F.least(F.floor(F.length(value) / 8), F.lit(4)).cast("int")
    return F.struct(
        span["kind"].alias("kind"),
        _vote(strict, ~strict).alias("pattern"),
        _vote(in_lists, ~in_lists).alias("gazetteer"),
        _vote(cue & ~other, other & ~cue).alias("context"),
        size.alias("size"),
    )


# --- reliabilities and classifier, over the counted lines -------------------------------------------------


def estimated(lines: list[dict]) -> tuple[dict, float, list[float]]:
    """Expectation-maximisation over lines of kind, votes and n.

    Returns per labeler the chances of a yes on personal and on other spans, the share of personal ones among the
    candidates, and per line the posterior (1 for base kinds).
    """
    chances, personal = dict(PRIORS), PRIOR_PERSONAL
    posterior: list[float] = []
    for _ in range(ROUNDS):
        posterior = []
        for line in lines:
            if line["kind"] < len(BASE):
                posterior.append(1.0)
                continue
            odds = log(personal / (1 - personal))
            for name in LABELERS:
                yes, wrong = chances[name]
                odds += {1: log(yes / wrong), -1: log((1 - yes) / (1 - wrong)), 0: 0.0}[line[name]]
            posterior.append(1 / (1 + exp(-odds)))
        open_ones = [(p, line["n"]) for p, line in zip(posterior, lines) if line["kind"] >= len(BASE)]
        personal = (PRIOR_WEIGHT * PRIOR_PERSONAL + sum(p * n for p, n in open_ones)) / (
            PRIOR_WEIGHT + sum(n for _, n in open_ones)
        )
        for name in LABELERS:
            right = [PRIOR_WEIGHT * PRIORS[name][0], PRIOR_WEIGHT]
            wrong = [PRIOR_WEIGHT * PRIORS[name][1], PRIOR_WEIGHT]
            for p, line in zip(posterior, lines):
                if line[name]:
                    right[0] += p * line["n"] * (line[name] > 0)
                    right[1] += p * line["n"]
                    wrong[0] += (1 - p) * line["n"] * (line[name] > 0)
                    wrong[1] += (1 - p) * line["n"]
            yes = min(max(right[0] / right[1], 0.01), 0.99)
            chances[name] = yes, min(max(wrong[0] / wrong[1], 0.01), 0.99, yes)  # a labeler is not worse than a coin
    return chances, personal, posterior


FEATURES = ["kind", *LABELERS, "size"]
_VALUES = {"kind": range(len(BASE), len(KINDS)), **{x: (-1, 0, 1) for x in LABELERS}, "size": range(5)}


def trained(lines: list[dict], posterior: list[float]) -> tuple[float, dict]:
    """Naive Bayes over the candidates' lines: the intercept and a weight per (feature, value), in log odds."""
    own = [(p, line) for p, line in zip(posterior, lines) if line["kind"] >= len(BASE)]
    personal = sum(p * line["n"] for p, line in own) + PRIOR_WEIGHT * PRIOR_PERSONAL
    other = sum((1 - p) * line["n"] for p, line in own) + PRIOR_WEIGHT * (1 - PRIOR_PERSONAL)
    weights = {}
    for name in FEATURES:
        values = _VALUES[name]
        believed = {v: (1.0, 1.0) for v in values}
        if name in PRIORS:
            yes, wrong = PRIORS[name]
            believed = {1: (yes, wrong), -1: (1 - yes, 1 - wrong), 0: (0.5, 0.5)}
        totals = [sum(b[i] for b in believed.values()) for i in (0, 1)]
        for v in values:
            share = [PRIOR_WEIGHT * b / t for b, t in zip(believed[v], totals)]
            here = [(p, line["n"]) for p, line in own if line[name] == v]
            yes = (share[0] + sum(p * n for p, n in here)) / (personal + PRIOR_WEIGHT)
            no = (share[1] + sum((1 - p) * n for p, n in here)) / (other + PRIOR_WEIGHT)
            weights[name, v] = log(yes / no)
    return log(personal / other), weights


def _accepted(vote: Column, intercept: float, weights: dict) -> Column:
    """Whether the classifier takes the candidate with these votes."""
    odds = F.lit(intercept)
    for name in FEATURES:
        table = F.create_map(*[F.lit(x) for v in _VALUES[name] for x in (int(v), weights[name, v])])
        odds = odds + F.coalesce(F.element_at(table, vote[name]), F.lit(0.0))
    return odds >= log(THRESHOLD / (1 - THRESHOLD))


# --- the operator ---------------------------------------------------------------------------------------


def _bare(spans: Column | str) -> Column:
    return F.transform(spans, lambda s: F.struct(*[s[x].alias(x) for x in ("start", "kind", "end")]))


def _voted(texts: DataFrame) -> DataFrame:
    """``texts`` with base, more (candidates with their votes) and counted (the votes of the base spans)."""
    found = with_candidates(with_base(texts))
    more = lambda chunks: F.transform(
        "candidates", lambda s: F.struct(*[s[x].alias(x) for x in ("start", "kind", "end")], votes(s, chunks).alias("vote"))
    )
    counted = lambda chunks: F.transform("base", lambda s: votes(s, chunks))
    text = F.when(F.size("base") + F.size("candidates") > 0, F.col("text")).otherwise(F.lit(""))  # without spans, no chunks
    both = _let(_chunked(text), lambda c: F.struct(more(c).alias("more"), counted(c).alias("counted")))
    told = found.withColumn("voted", both).withColumns({"more": F.col("voted.more"), "counted": F.col("voted.counted")})
    return told.withColumn("base", _bare("base")).drop("candidates", "voted")


def _classifier(voted: DataFrame) -> tuple[float, dict]:
    """From the counted votes of all spans; what reaches the driver is one line per kind, votes and size class."""
    every = voted.select(F.explode(F.concat("counted", F.transform("more", lambda s: s["vote"]))).alias("v")).select("v.*")
    lines = [row.asDict() for row in every.groupBy(*FEATURES).agg(F.count("*").alias("n")).orderBy(*FEATURES).collect()]
    _, _, posterior = estimated(lines)
    return trained(lines, posterior)


def _all_spans(intercept: float, weights: dict) -> Column:
    taken = F.filter("more", lambda s: _accepted(s["vote"], intercept, weights))
    return F.array_sort(F.concat("base", _bare(taken)))


def _name(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _name(s["kind"]), s["start"], s["end"])), ",")


def _count_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base spans, and all spans."""
    voted = stored(_voted(whole_texts(docs)).drop("text"))
    found = voted.withColumn("spans", _all_spans(*_classifier(voted)))
    counts = [_count_of("base", n).alias(f"n_{kind}") for n, kind in enumerate(BASE)]
    digest = F.sha2(_written(F.col("base")), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def _masked(text: Column, spans: Column) -> Column:
    """The text with [KIND] in place of the spans, which come by start."""

    def of(ordered: Column, chunks: Column) -> Column:
        before = _before(ordered, lambda s: s["end"], _largest)
        placed = F.zip_with(ordered, before, lambda s, at: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), at.alias("at")))
        taken = F.filter(placed, lambda p: p["start"] >= p["at"])
        tag = lambda p: F.concat(F.lit("["), F.upper(_name(p["kind"])), F.lit("]"))
        parts = F.transform(taken, lambda p: F.concat(_cut(chunks, p["at"], p["start"]), tag(p)))
        last = F.aggregate(ordered, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
        return F.concat(F.array_join(parts, ""), _let(last, lambda at: _cut(chunks, at, F.length(text))))

    return _let(spans, lambda s: _let(_chunked(text), lambda c: of(s, c)))


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with [KIND] in place of every span, and n_chars to match; nothing is shuffled for it.

    Where spans of two kinds overlap, the one that begins first gives the name and both are taken out. Rows
    without spans, null texts among them, stay as they are. Spans and votes are stored once with their rows; votes are counted
    and texts masked from there.
    """
    parts = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    voted = stored(_voted(parts).drop("text"))
    found = voted.withColumn("spans", _all_spans(*_classifier(voted)))
    found = found.withColumn("masked", F.when(F.size("spans") > 0, _masked(F.col("row.text"), F.col("spans"))))
    own = {c: F.col("row")[c] for c in docs.columns}
    own["text"] = F.coalesce("masked", own["text"])
    if "n_chars" in own:
        own["n_chars"] = F.coalesce(F.length("masked").cast("long"), own["n_chars"])
    return found.select(*[column.alias(c) for c, column in own.items()])
