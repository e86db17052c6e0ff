"""Phrases of two and three words that stand together more often than their parts would, per language.

*Count streams.* The tasks that read texts count, per slice, each word and each pair of words together with the word that
follows it. These partial counts are dealt by (language, word or pair) and sorted: one stream of counts in prefix order.
It is read once from front to back, with no table of phrases in memory: neighbouring rows of one phrase are added
up, and as all that begins with a pair stands together, the count of the pair, the counts of its followers and the most
frequent follower come out of the same run. Only phrases that are frequent enough leave the stream.

*Merge joins.* What is left is cut into (left part, right part). Cuts sorted by the left part (prefix order) and by the
right part (suffix order) meet the sorted stream of words and pairs in merge joins, which give the counts of both
parts; the three-word phrases in suffix order give the extensions to the left. A part that holds more than a
thousandth of all words is looked up by broadcast instead (there are at most 2,000 such parts), so that no task gets all
cuts of a frequent word.

Texts are lower-cased (A-Z only) and split into pieces at ``.,;:!?`` and line breaks; phrases never reach across pieces. A
null language is ``und``, a null text the empty one. Repeated rows count as often as they come; an empty table gives
no rows; other columns, whatever their names, stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import mapped, text_slices
from tillworks.session import stored

HOT_SHARE = 1 / 1000

_BREAKS = r"[.,;:!?\x0A-\x0D]"
_PARTIAL = pa.schema([("lang", pa.string()), ("head", pa.string()), ("last", pa.string()), ("n", pa.int64())])
_TOLD = "lang string, head string, last string, a long, l long, ext long"


# --- partial counts -------------------------------------------------------------------------------------


def _words(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words in byte order, and of each word in the texts its number, its piece and its document."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), _BREAKS)
    split = pc.ascii_split_whitespace(pieces.flatten())  # pieces hold no other white space than spaces and tabs
    coded = split.flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), dtype=np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    piece = pc.list_parent_indices(split).to_numpy().astype(np.int64)
    found = place[coded.indices.to_numpy()]
    dictionary = coded.dictionary.take(order)
    if len(dictionary) and dictionary[0].as_py() == "":
        found, piece = found[found > 0], piece[found > 0]
    return dictionary, found, piece, pc.list_parent_indices(pieces).to_numpy()[piece]


def _slice_counts(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Counts of each word (no ``last``) and of each pair with its follower (empty where the piece ends)."""
    words, word, piece, doc = _words(part)
    if not len(word):
        return
    langs = part.column("lang").dictionary_encode()
    lang = langs.indices.to_numpy()[doc].astype(np.int64)
    # a number for every (language, word); those of one language follow each other in the order of the words
    both, number, counts = np.unique(lang * len(words) + word, return_inverse=True, return_counts=True)
    lang_of, text = langs.dictionary.take(pa.array(both // len(words))), words.take(pa.array(both % len(words)))
    ends = pa.array([""] * len(both), pa.string())
    yield pa.RecordBatch.from_arrays([lang_of, text, ends, pa.array(counts)], schema=_PARTIAL)
    begins = np.flatnonzero(piece[1:] == piece[:-1])
    pairs, pair = np.unique(number[begins] << 32 | number[begins + 1], return_inverse=True)
    follower = np.zeros(len(begins), dtype=np.int64)
    goes_on = np.append(begins[1:] == begins[:-1] + 1, False) if len(begins) else np.zeros(0, dtype=bool)
    goes_on[goes_on] = piece[begins[goes_on] + 2] == piece[begins[goes_on]]
    follower[goes_on] = number[begins[goes_on] + 2] + 1
    grams, n = np.unique(pair.astype(np.int64) << 32 | follower, return_counts=True)
    heads = pc.binary_join_element_wise(text.take(pa.array(pairs >> 32)), text.take(pa.array(pairs & 0xFFFFFFFF)), " ")
    last = pc.fill_null(text.take(pa.array((grams & 0xFFFFFFFF) - 1, mask=(grams & 0xFFFFFFFF) == 0)), "")
    at = pa.array(grams >> 32)
    yield pa.RecordBatch.from_arrays([lang_of.take(pa.array(pairs >> 32)).take(at), heads.take(at), last, pa.array(n)], schema=_PARTIAL)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            yield from _slice_counts(part)


# --- the stream in prefix order -------------------------------------------------------------------------


def _changes(rows: pa.Table, names: list[str]) -> np.ndarray:
    """Whether each row differs in one of the columns from the row before; the first one does."""
    changed = np.ones(len(rows), dtype=bool)
    changed[1:] = False
    for name in names:
        column = rows[name].combine_chunks()
        changed[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)
    return changed


def _added_up(rows: pa.Table) -> pa.Table:
    """Neighbouring rows of one (head, last) as one."""
    starts = np.flatnonzero(_changes(rows, ["lang", "head", "last"]))
    n = np.add.reduceat(rows["n"].to_numpy(), starts)
    return rows.take(pa.array(starts)).set_column(3, "n", pa.array(n))


def _still_open(rows: pa.Table, least: int) -> pa.Table:
    """The rows of a head that is not complete yet: followers that are, and are too rare, become part of its first row."""
    n = rows["n"].to_numpy().copy()
    kept = n >= least
    kept[[0, -1]] = True
    if rows["last"][0].as_py() == "":
        n[0] += n[~kept].sum()
        return rows.set_column(3, "n", pa.array(n)).filter(pa.array(kept))
    spare = pa.table([rows["lang"].slice(0, 1), rows["head"].slice(0, 1), pa.array([""]), pa.array([n[~kept].sum()])], schema=_PARTIAL)
    return pa.concat_tables([spare, rows.filter(pa.array(kept))])


def _complete(rows: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """What complete heads tell: frequent heads with their best follower, frequent grams with the count of their head."""
    starts = np.flatnonzero(_changes(rows, ["lang", "head"]))
    n = rows["n"].to_numpy()
    follows = pc.not_equal(rows["last"], "").to_numpy().astype(bool)
    total, best = np.add.reduceat(n, starts), np.maximum.reduceat(np.where(follows, n, 0), starts)
    heads = rows.take(pa.array(starts))
    often = total >= least
    none = pa.nulls(int(often.sum()), pa.int64())
    frequent = heads.filter(pa.array(often))
    last = pa.nulls(len(frequent), pa.string())
    yield from _told(frequent["lang"], frequent["head"], last, total[often], none, best[often])
    grams = follows & (n >= least)
    if grams.any():
        of = np.repeat(total, np.diff(np.append(starts, len(n))))[grams]
        found = rows.filter(pa.array(grams))
        yield from _told(found["lang"], found["head"], found["last"], n[grams], of, pa.nulls(len(found), pa.int64()))
    single = pc.invert(pc.match_substring(heads["head"], " "))
    sums = pa.table({"lang": heads["lang"], "n": total}).filter(single).group_by("lang").aggregate([("n", "sum")])
    words, blank = pa.nulls(len(sums), pa.string()), pa.nulls(len(sums), pa.int64())
    yield from _told(sums["lang"], words, words, sums["n_sum"], blank, blank)


def _told(*columns) -> list[pa.RecordBatch]:
    return pa.table(list(columns), names=["lang", "head", "last", "a", "l", "ext"]).to_batches()


def _prefix_order(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _added_up(pa.concat_tables([*waiting, pa.Table.from_batches([batch]).cast(_PARTIAL)]).combine_chunks())
            cut = int(np.flatnonzero(_changes(rows, ["lang", "head"]))[-1])
            if cut:
                yield from _complete(rows.slice(0, cut).combine_chunks(), least)
            waiting = [_still_open(rows.slice(cut).combine_chunks(), least)]
        if waiting:
            yield from _complete(waiting[0].combine_chunks(), least)

    return run


def frequent_phrases(docs: DataFrame, least: int) -> DataFrame:
    """Rows of three kinds. (lang, head, a, ext): a word or pair with its count and that of its most frequent follower;
    (lang, head, last, a, l): a phrase of three words with its count and that of its first two; (lang, a): all words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    partial = mapped(texts, _partial_counts, "lang string, head string, last string, n long")
    stream = partial.repartition("lang", "head").sortWithinPartitions("head", "lang", "last")
    return mapped(stream, _prefix_order(least), _TOLD)


# --- parts and scores -----------------------------------------------------------------------------------


def _with_count(cuts: DataFrame, heads: DataFrame, hot: DataFrame, part: str, name: str) -> DataFrame:
    """``cuts`` with the count of a part; every part is as frequent as its phrase, so it is among the heads."""
    asked = cuts.join(F.broadcast(hot.select("lang", F.col("head").alias(part), F.col("a").alias("_hot"))), ["lang", part], "left")
    counts = heads.select("lang", F.col("head").alias(part), F.col("a").alias(name))
    merged = asked.where("_hot IS NULL").drop("_hot").join(counts.hint("merge"), ["lang", part])
    return merged.unionByName(asked.where("_hot IS NOT NULL").withColumnRenamed("_hot", name))


def collocations(docs: DataFrame, least: int = 10, inside: int = 50, best: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the ``best`` phrases of each language.

    ``a``: count of the phrase, at least ``least``; ``l`` and ``r``: counts of the parts of its weakest cut; ``n``: all
    words of the language; score: ``floor(10^6 * a * a / (l * r))``, in decimals. A pair inside a longer candidate that
    makes up ``inside`` percent of its count is left out.
    """
    told = stored(frequent_phrases(docs, least))
    per_lang = stored(told.where("head IS NULL").groupBy("lang").agg(F.sum("a").alias("n")))
    heads = told.where("head IS NOT NULL AND last IS NULL").select("lang", "head", "a", "ext")
    triples = told.where("last IS NOT NULL").select("lang", "head", "last", "a", "l")
    first, second = F.substring_index("head", " ", 1), F.substring_index("head", " ", -1)
    tail = F.concat_ws(" ", second, "last")
    total = per_lang.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = heads.where(F.col("a") > total * HOT_SHARE)

    before = triples.groupBy("lang", tail.alias("head")).agg(F.max("a").alias("before"))
    pairs = heads.where(F.contains("head", F.lit(" "))).join(before.hint("merge"), ["lang", "head"], "left")
    longest = F.greatest("ext", F.coalesce("before", F.lit(0)))  # 0: inside no candidate
    alone = pairs.where((longest < least) | (100 * longest < inside * F.col("a")))

    of_pairs = alone.select("lang", F.col("head").alias("phrase"), "a", F.lit(1).alias("k"), first.alias("left"), second.alias("right"))
    phrase = F.concat_ws(" ", "head", "last").alias("phrase")
    front = triples.select("lang", phrase, "a", F.lit(1).alias("k"), first.alias("left"), tail.alias("right"))
    back = triples.select("lang", phrase, "a", F.lit(2).alias("k"), F.col("head").alias("left"), F.col("last").alias("right"), "l")
    in_prefix_order = _with_count(of_pairs.unionByName(front), heads, hot, "left", "l").unionByName(back)
    cuts = _with_count(in_prefix_order, heads, hot, "right", "r")
    score = F.expr("(cast(a as decimal(19, 0)) * a * 1000000BD) div (cast(l as decimal(19, 0)) * r)")
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    scored = weakest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    named = ranked.join(per_lang, "lang")
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATION_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, 1 AS size, w[i] AS phrase FROM places
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM places WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 2 <= len(w)),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10),
longer AS (
  SELECT lang, w[1] || ' ' || w[2] AS phrase, f FROM candidates WHERE size = 3
  UNION ALL SELECT lang, w[2] || ' ' || w[3], f FROM candidates WHERE size = 3),
longest AS (SELECT lang, phrase, max(f) AS most FROM longer GROUP BY lang, phrase),
left_out AS (
  SELECT c.lang, c.phrase FROM candidates c JOIN longest g USING (lang, phrase) WHERE c.size = 2 AND 100 * g.most >= 50 * c.f),
kept AS (SELECT * FROM candidates ANTI JOIN left_out USING (lang, phrase)),
cuts AS (
  SELECT lang, phrase, f, 1 AS k, w[1] AS left_part, array_to_string(w[2:], ' ') AS right_part FROM kept
  UNION ALL SELECT lang, phrase, f, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE size = 3),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r,
    CAST(1000000 AS HUGEINT) * c.f * c.f // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.left_part
  JOIN counts y ON y.lang = c.lang AND y.phrase = c.right_part),
weakest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
