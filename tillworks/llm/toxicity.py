"""Toxicity by a learned lexicon, matched with Levenshtein automata, and the context of the matches.

*Lexicon.* From labelled texts Spark counts, per word, in how many toxic and clean ones it stands. Words that are
frequent enough and almost only in toxic texts become terms. Beginnings that many different words share, again almost
only in toxic texts, become stems. Of these stay the ones that are the best entry of some toxic texts: words that
only stand beside better ones explain nothing. Both lists are bounded by the support they need.

*Matching.* The terms form a trie. Its product with the Levenshtein automaton of the word at hand (one edit for terms of
five letters and more) is run letter by letter; states of the product are made when first met and kept, so a word
costs one look-up per letter until no term can follow any more. Edits that many plain words are away from a term too
are sorts of match of their own (``WEAK``): a wrong, missing or extra first letter, an edit of a telling word that a
stem stands for, an edit inside a stem. Texts without other matches tell what each of these is worth; a sort that is
no more toxic than texts without any match changes no score and is no longer looked for.

*Context.* A match counts in full as abuse, less where it is quoted: between quotation marks, or with a word of saying or
naming close before it and nobody addressed. The share of toxic texts among those with a match of each sort
(exact, stem, misspelled; used or quoted) is learned from the same labelled texts. The score of a
text is one minus the product of the chances that each of its matches is harmless; of its weak sorts the worst counts, once.

Labels teach only through rows that are not held out. Language, source and ids are never read for a score. A null text
is the empty one; without any match a text gets the base score. Without labelled rows the lexicon is empty. Repeated
rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log
from statistics import median

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import mapped, mixed, text_slices, whole_texts
from tillworks.llm.simhash import shingle_hashes
from tillworks.llm.word_ids import Remembered
from tillworks.session import stored

THRESHOLD = 0.7
#: Labelled texts that the lexicon is learned from; those with the smallest hashes of their ids.
SAMPLE = 40_000
LEAST_TEXTS, PRECISION, FALSE_SHARE = 3, 0.9, 0.02
STEM_LETTERS, STEM_WORDS = (4, 5, 6, 7, 8), 4
EDIT_LETTERS = 5
WINDOW = 6
#: Edits at the first letter of a term; of a word under a stem; inside a stem of ``EDIT_LETTERS`` and more; of fewer.
WEAK = ("first letter", "stem word", "near stem", "near short stem")

# Words that announce a quotation, words that address somebody, and quotation marks.
SAYING = set(
    "said says say called calls call wrote writes quoted quote quotes term word words phrase named sagte sagt nannte"
    " genannt wort zitat begriff dit disait appelle mot terme citation dijo dice palabra cita".split()
)
ADDRESSING = set("you your youre are du dich dein bist ihr euch tu toi vous es ton eres usted".split())
OPENING, CLOSING = "\"'“‘«„‹", "\"'”’»“›"

_WORD = re.compile(r"[^\W_]+")


# --- the trie and the automaton -------------------------------------------------------------------------


@dataclass
class Lexicon:
    """Terms and stems. ``find`` gives (entry, sort) for a lower-case word, or None.

    ``stem_words``: telling words that begin with a stem; ``weak``: the weak sorts that are looked for.
    """

    terms: list[str]
    stems: list[str]
    edit_letters: int = EDIT_LETTERS
    stem_words: list[str] = field(default_factory=list)
    weak: frozenset[str] = frozenset()
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[tuple[str, str] | None] = field(default_factory=lambda: [None])

    def __post_init__(self) -> None:
        kinds = (self.stem_words, "stem word"), (self.terms, "term"), (self.stems, "stem")
        for entry, sort in [(entry, sort) for entries, sort in kinds for entry in entries]:
            node = 0
            for letter in entry:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                node = self.children[node][letter]
            self.ends[node] = (entry, sort)
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.near: list[str | None] = []  # the longest stem that what was read may be, of those looked for
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, reached: set[tuple[int, int]]) -> frozenset:
        """With the trie nodes that a letter left out leads to; of one node only the fewest edits."""
        for node, edits in list(reached):
            if edits == 0:
                reached.update((child, 1) for child in self.children[node].values())
        return frozenset((n, e) for n, e in reached if e == 0 or (n, 0) not in reached)

    def _state(self, reached: frozenset) -> int:
        if reached not in self.states:
            self.states[reached] = len(self.members)
            self.members.append(reached)
            self.moves.append({})
            stems = [self.ends[n][0] for n, _ in reached if self.ends[n] and self.ends[n][1] == "stem"]
            stems = [stem for stem in stems if self._near_sort(stem) in self.weak]
            self.near.append(max(stems, key=lambda stem: (len(stem), stem), default=None))
        return self.states[reached]

    def _near_sort(self, stem: str) -> str:
        return "near stem" if len(stem) >= self.edit_letters else "near short stem"

    def _move(self, state: int, letter: str) -> int:
        after = set()
        for node, edits in self.members[state]:
            child = self.children[node].get(letter)
            if child is not None:
                after.add((child, edits))
            if edits == 0:
                after.add((node, 1))  # a letter too many
                after.update((c, 1) for other, c in self.children[node].items() if other != letter)
        # what a letter left out leads to is added for the nodes without edits
        moved = self._state(self._closed(after))
        self.moves[state][letter] = moved
        return moved

    def stems_of(self, word: str) -> Iterator[str]:
        """All stems that the word begins with and goes on from."""
        node = 0
        for letter in word[:-1]:
            node = self.children[node].get(letter, -1)
            if node < 0:
                return
            if self.ends[node] and self.ends[node][1] == "stem":
                yield self.ends[node][0]

    def find(self, word: str) -> tuple[str, str] | None:
        """An exact term first, then the longest stem, then a term one edit away, then the weak sorts in their order."""
        node, stem = 0, None
        for i, letter in enumerate(word):
            node = self.children[node].get(letter, -1)
            if node < 0:
                break
            end = self.ends[node]
            if end and end[1] == "stem":
                stem = end
            if end and i == len(word) - 1 and end[1] != "stem word":
                return end
        if stem:
            return stem
        state, near = self.start, ""
        for letter in word:
            moves = self.moves[state]
            state = moves[letter] if letter in moves else self._move(state, letter)
            if not self.members[state]:
                break
            if (begun := self.near[state]) and (len(begun), begun) > (len(near), near):
                near = begun
        ends = [self.ends[n] for n, _ in self.members[state] if self.ends[n]]
        close = [(e[0], e[1]) for e in ends if e[1] != "stem" and len(e[0]) >= self.edit_letters]
        terms = [entry for entry, sort in close if sort == "term"]
        if same := [entry for entry in terms if entry[:1] == word[:1]]:
            return min(same), "misspelled"
        if terms and "first letter" in self.weak:
            return min(terms), "first letter"
        if "stem word" in self.weak and (under := [entry for entry, sort in close if sort == "stem word"]):
            return min(under), "stem word"
        return (near, self._near_sort(near)) if near else None


def quoted(text: str, start: int, end: int, before: list[str], after: list[str]) -> bool:
    """Whether a match stands between quotation marks, or behind a word of saying with nobody addressed."""
    if text[max(0, start - 1) : start] in OPENING and start and text[end : end + 1] in CLOSING and end < len(text):
        return True
    around = set(before) | set(after)
    return bool(set(before) & SAYING) and not around & ADDRESSING


class Matcher:
    """Finds the matches of texts; what a stretch between white space holds is remembered."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.memory = lexicon, Remembered()

    def hit(self, stretch: str) -> bool:
        known = self.memory.find(stretch)
        if known is None:
            known = any(self.lexicon.find(w) for w in self.words(stretch.lower()))
            self.memory.put(stretch, known)
        return known

    @staticmethod
    def words(stretch: str) -> list[str]:
        """The words of a stretch, and the whole of it where signs stand inside (for letters replaced by signs)."""
        found = _WORD.findall(stretch)
        return found if len(found) < 2 else [*found, stretch.strip(".,;:!?()[]\"'“”‘’«»")]

    def hits(self, stretches: list[str]) -> list[bool]:
        known = list(map(self.memory.young.get, stretches))
        return [self.hit(s) if found is None else found for s, found in zip(stretches, known)]

    def matches(self, text: str) -> Counter:
        """Numbers of matches by (entry, sort, quoted); places and neighbours are looked up for the stretches that match."""
        small = text.lower()
        stretches = small.split()
        found: Counter = Counter()
        reached, end = 0, 0
        for i in [i for i, hit in enumerate(self.hits(stretches)) if hit]:
            for stretch in stretches[reached : i + 1]:
                a = small.find(stretch, end)
                end = a + len(stretch)
            reached = i + 1
            before = [w for s in stretches[max(0, i - WINDOW) : i] for w in _WORD.findall(s)]
            after = [w for s in stretches[i + 1 : i + 1 + WINDOW] for w in _WORD.findall(s)]
            for word in self.words(stretches[i]):
                entry = self.lexicon.find(word)
                if entry:
                    at = small.find(word, a)
                    found[(*entry, quoted(small, at, at + len(word), before, after))] += 1
        return found

    def of_batch(self, texts: pa.Array) -> list[Counter]:
        """Matches of each text; only texts with a stretch that can match are looked at word by word."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        hits = np.array(self.hits(coded.dictionary.to_pylist()), dtype=bool)
        at = np.concatenate([[0], np.cumsum(hits[coded.indices.to_numpy()])]) if len(hits) else np.zeros(1, dtype=int)
        bounds = np.asarray(split.offsets) - split.offsets[0].as_py()
        some = at[bounds[1:]] > at[bounds[:-1]]
        return [self.matches(texts[i].as_py()) if x else Counter() for i, x in enumerate(some.tolist())]


# --- learning -------------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text and toxic of at most ``sample`` labelled rows that are not held out; of near copies with one label the first.

    Near copies are texts that agree in all ``COPY_ROWS`` smallest hashes of one of ``COPY_BANDS`` bands: of texts that share 0.9
    of their three-word shingles 99.8 percent do, of 0.5 a third, of 0.3 a twentieth. So a passage in common makes no copies.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = whole_texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")  # at most ``sample`` ids
    kind = texts.schema["doc_id"].dataType.simpleString()
    marked = stored(mapped(texts, _with_copy_keys, f"doc_id {kind}, text string, toxic int, copies array<long>"))
    row = F.struct("doc_id", F.xxhash64("text").alias("hash"))
    kept = marked.select(row.alias("row"), "toxic", "copies")
    for band in range(COPY_BANDS):
        first = kept.groupBy(F.col("copies")[band], "toxic").agg(F.min(F.struct("row", "copies")).alias("first"))
        kept = first.select("first.row", "toxic", "first.copies")
    chosen_ones = stored(kept.select("row"))
    return stored(marked.withColumn("row", row).join(chosen_ones, "row", "left_semi").dropDuplicates(["row"]).select("text", "toxic"))


COPY_BANDS, COPY_ROWS = 6, 4
_ODD = np.uint64(0x9E3779B97F4A7C15)
_COPY_SALTS = mixed(np.arange(1, COPY_BANDS * COPY_ROWS + 1, dtype=np.uint64) << np.uint64(40))


def _with_copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the keys of the bands: mixed from the smallest hashes of three words in a row."""
    for batch in batches:
        keys = []
        for text in batch.column("text").to_pylist():
            blocks = list(shingle_hashes(text.encode(), 3))
            least = np.zeros(len(_COPY_SALTS), dtype=np.uint64)
            if blocks:
                hashes = np.concatenate(blocks)
                least = np.array([((hashes ^ salt) * _ODD).min() for salt in _COPY_SALTS], dtype=np.uint64)
            key = np.arange(COPY_BANDS, dtype=np.uint64)
            for column in least.reshape(COPY_BANDS, COPY_ROWS).T:
                key = mixed(key ^ column)
            keys.append(key.view(np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text", "toxic", "copies"])


def word_counts(texts: DataFrame) -> DataFrame:
    """word, toxic and clean: the numbers of texts it stands in."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{Nd}]+"))
    each = texts.select("toxic", F.explode(words).alias("word")).where(F.length("word").between(3, 40))
    return each.groupBy("word").agg(
        F.sum("toxic").cast("long").alias("toxic"), F.sum(1 - F.col("toxic")).cast("long").alias("clean")
    )


def _chance(toxic: int, clean: int, share: float) -> float:
    """Upper bound (Chernoff) of the chance of so many toxic texts among these if a word said nothing; logarithm."""
    n, part = toxic + clean, toxic / (toxic + clean)
    if part <= share:
        return 0.0
    other = (1 - part) * log((1 - part) / (1 - share)) if part < 1 else 0.0
    return -n * (part * log(part / share) + other)


def _telling(rows: list, share: float, tests: int) -> set[str]:
    """The entries that are not chance finds among ``tests`` tried ones (Benjamini and Hochberg's rule)."""
    ranked = sorted((_chance(r["toxic"], r["clean"], share), r[0]) for r in rows)
    kept = [i for i, (chance, _) in enumerate(ranked, 1) if chance <= log(FALSE_SHARE * i / max(1, tests))]
    return {entry for _, entry in ranked[: max(kept, default=0)]}


def _stems_in(lexicon: Lexicon):
    """(stem, toxic) of every text and stem in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stems, toxic = [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = {s for word in set(_WORD.findall(text.lower())) for s in lexicon.stems_of(word)}
                stems.extend(found)
                toxic.extend([label] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(toxic, pa.int32())], names=["stem", "toxic"])

    return run


def learned_lexicon(texts: DataFrame, counts: DataFrame, share: float) -> Lexicon:
    """Terms and stems; ``share``: that of toxic texts among the labelled ones.

    A term needs LEAST_TEXTS toxic texts: texts of n distinct words bring in n / LEAST_TEXTS terms each at most.
    """
    enough = (F.col("toxic") >= LEAST_TEXTS) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean")))
    tried = F.count_if(F.col("toxic") + F.col("clean") >= LEAST_TEXTS)
    starts = F.transform(F.array(*map(F.lit, STEM_LETTERS)), lambda n: F.substring("word", F.lit(1), n))
    long_enough = F.filter(starts, lambda s: F.length(s) < F.length("word"))
    stems = stored(
        counts.select("toxic", "clean", F.explode(F.array_distinct(long_enough)).alias("stem"))
        .groupBy("stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count("*").alias("words"))
        .where(F.col("words") >= STEM_WORDS)
    )
    # these counts are of words; texts with several words of a stem count once
    hopeful = Lexicon([], sorted(row[0] for row in stems.where(enough).select("stem").collect()))
    in_texts = mapped(texts, _stems_in(hopeful), "stem string, toxic int").groupBy("stem").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    stem_rows = in_texts.where(enough).collect()
    found = _telling(stem_rows, share, stems.agg(tried).first()[0])
    # the shortest of the stems that begin each other says it all
    found = {s for s in found if not any(s[:n] in found for n in range(min(STEM_LETTERS), len(s)))}
    term_rows = counts.where(enough).select("word", "toxic", "clean").collect()
    terms = _telling(term_rows, share, counts.agg(tried).first()[0])
    telling = terms
    terms = {t for t in terms if not any(t[:n] in found for n in STEM_LETTERS)}

    # Words that only keep company with better ones (those of a toxic text with copies, say) explain no text.
    support = {row[0]: row["toxic"] for row in [*stem_rows, *term_rows] if row[0] in found or row[0] in terms}
    every = Lexicon(sorted(terms), sorted(found))
    best = mapped(texts.where("toxic = 1"), _best_entries(every, support), "entry string").distinct()
    needed = {row["entry"] for row in best.collect()}
    if needed:  # entries as frequent as those are no mere company either
        usual = median(support[entry] for entry in needed)
        needed |= {entry for entry, n in support.items() if n >= usual / 4}
    found &= needed
    under = [t for t in telling if any(t[:n] in found for n in STEM_LETTERS if n < len(t))]
    return Lexicon(sorted(terms & needed), sorted(found), stem_words=sorted(under), weak=frozenset(WEAK))


def _best_entries(lexicon: Lexicon, support: dict[str, int]):
    """Of every text, the entry in it that stands in the most toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for text in batch.column("text").to_pylist():
                words = set(_WORD.findall(text.lower()))
                found = {s for word in words for s in lexicon.stems_of(word)} | (words & support.keys())
                if found:
                    best.append(max(found, key=lambda entry: (support[entry], entry)))
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.string())], names=["entry"])

    return run


@dataclass
class Model:
    lexicon: Lexicon
    #: (sort, quoted) -> chance that a text with such matches only is toxic
    chances: dict[tuple[str, bool], float]
    base: float

    def score(self, found: Counter) -> float:
        harmless, worst = 1.0 - self.base, self.base
        for (_, sort, in_quotes), n in found.items():
            if sort in WEAK:
                worst = max(worst, self.chances[sort, in_quotes])
            else:
                harmless *= (1.0 - self.chances[sort, in_quotes]) ** min(n, 50)
        return 1.0 - (harmless * (1.0 - worst) / (1.0 - self.base) if worst > self.base else harmless)


#: What is believed of a match before any text speaks for or against it, with the weight of two texts.
BELIEFS = {
    ("term", False): 0.9,
    ("term", True): 0.3,
    ("stem", False): 0.85,
    ("stem", True): 0.3,
    ("misspelled", False): 0.75,
    ("misspelled", True): 0.2,
    ("first letter", False): 0.75,
    ("first letter", True): 0.2,
    ("stem word", False): 0.75,
    ("stem word", True): 0.2,
    ("near stem", False): 0.75,
    ("near stem", True): 0.2,
    ("near short stem", False): 0.75,
    ("near short stem", True): 0.2,
}


def _sorts_of(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            for part in text_slices(batch):
                found = matcher.of_batch(part.column("text"))
                sorts = [",".join(sorted({f"{sort}:{int(q)}" for _, sort, q in x})) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(sorts), part.column("toxic")], names=["sorts", "toxic"])

    return run


def learned_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    texts = training_texts(docs, labels, sample)
    n, toxic = texts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < n:  # nothing to tell apart
        return Model(Lexicon([], []), dict(BELIEFS), (toxic + 0.01) / (n + 1))
    lexicon = learned_lexicon(texts, stored(word_counts(texts)), toxic / n)
    told = mapped(texts, _sorts_of(lexicon), "sorts string, toxic int")
    rows = told.groupBy("sorts").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()  # 2^14 at most
    split = [({(x[:-2], x[-1] == "1") for x in r["sorts"].split(",") if x}, r["n"], r["toxic"]) for r in rows]
    strong = [({x for x in sorts if x[0] not in WEAK}, n, toxic) for sorts, n, toxic in split]
    plain = [row for row, (firm, _, _) in zip(split, strong) if not firm]  # texts with weak matches at most
    chances = {}
    for kind, belief in BELIEFS.items():
        told_by = [row for row in plain if kind in row[0]] if kind[0] in WEAK else [row for row in strong if row[0] == {kind}]
        n, toxic = _summed(told_by)
        chances[kind] = (toxic + 2 * belief) / (n + 2)
    base = _base(plain)
    worth = {kind for kind in BELIEFS if kind[0] in WEAK and chances[kind] > base}
    lexicon = Lexicon(
        lexicon.terms, lexicon.stems, lexicon.edit_letters, lexicon.stem_words, frozenset(sort for sort, _ in worth)
    )
    return Model(lexicon, chances, min(base, _base([row for row in plain if not row[0] & worth])))


def _summed(rows: list[tuple[set, int, int]]) -> tuple[int, int]:
    return sum(n for _, n, _ in rows), sum(toxic for _, _, toxic in rows)


def _base(rows: list[tuple[set, int, int]]) -> float:
    n, toxic = _summed(rows)
    return (toxic + 0.01) / (n + 1)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.lexicon)
        for batch in batches:
            for part in text_slices(batch):
                scores = [model.score(x) for x in matcher.of_batch(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, taught_by: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted. ``taught_by``: the documents of the labels, where ``docs`` are others."""
    model = learned_model(docs if taught_by is None else taught_by, labels)
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = mapped(texts, _scores(model), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def _clean_rows(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.lexicon)
        for batch in batches:
            for part in text_slices(batch):
                texts = pc.fill_null(part.column("text"), "")
                keep = [model.score(x) < threshold for x in matcher.of_batch(texts)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return run


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, taught_by: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose texts are not predicted toxic; nothing is shuffled for it."""
    model = learned_model(docs if taught_by is None else taught_by, labels)
    return mapped(docs, _clean_rows(model, threshold), docs.schema)
