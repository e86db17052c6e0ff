"""How far the sources of a language differ in the terms they use.

*Counting* is an Arrow compute pipeline inside the scan's tasks: lower case of A-Z, split at everything that is no letter,
dictionary codes, and two groupings (per document, then per language and source) give partial counts. Spark adds
them up, and a language keeps the terms that enough of its documents hold.

*Divergences* come from columnar shards. A shard holds some terms of a language with all their sources: a matrix of
chances, most of whose cells are that of a count of zero. A language has a shard for every ``SHARD_CELLS`` counts. Only cells with a count are computed one by one; the
sums of all shards are added up. Where a language has very many sources, a shard is cut into tiles of sources, each of
which meets all sources, so no task holds more than ``TILE`` rows of the matrix of pairs.

All arithmetic is on whole numbers: ``p = 1 + floor(SCALE * (count + 1) / (N + V))`` with N the counts of the V kept terms
in a source (or language), and the divergence of p from q in one term is ``floor((p - q) * (p - q) / q)``.

A null text, language or source counts as the empty one. Groups without terms are groups; with no kept term in their
language every pair has value 0. Repeated rows count as documents of their own; an empty table gives no rows; other
columns, whatever their names, stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import mapped, runs, text_slices
from tillworks.session import stored

SCALE = 1_000_000_000
TILE = 1_000
SHARD_CELLS = 250_000  # cells (term, source) of a shard, on average

_NO_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_HELD_ROWS = 300_000
_BLOCK_CELLS = 1 << 21
_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


# --- counting -------------------------------------------------------------------------------------------


def _slice_counts(part: pa.RecordBatch) -> pa.Table:
    """Partial counts of some documents; a row without a term tells that the group occurs."""
    split = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), _NO_LETTERS)
    coded = split.flatten().dictionary_encode()
    words = pa.table({"doc": pc.list_parent_indices(split), "code": coded.indices})
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:
        words = words.filter(pc.not_equal(words["code"], empty))
    in_doc = words.group_by(["doc", "code"]).aggregate([([], "count_all")])
    groups = {name: part.column(name).dictionary_encode() for name in ("lang", "source")}
    placed = {name: g.indices.take(in_doc["doc"]) for name, g in groups.items()}
    table = pa.table({**placed, "code": in_doc["code"], "n": in_doc["count_all"]})
    found = table.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ("n", "count")])
    texts = [g.dictionary.take(found[name]) for name, g in groups.items()]
    counted = pa.table([*texts, coded.dictionary.take(found["code"]), found["n_sum"], found["n_count"]], schema=_PARTIAL)
    rows = pa.table({name: part.column(name) for name in groups}).group_by(["lang", "source"]).aggregate([([], "count_all")])
    none = pa.nulls(len(rows), pa.string())
    there = pa.table([rows["lang"], rows["source"], none, pa.array(np.zeros(len(rows), np.int64)), rows["count_all"]], schema=_PARTIAL)
    return pa.concat_tables([counted, there])


def _merged(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return found.rename_columns(_PARTIAL.names)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for part in text_slices(batch):
            held.append(_slice_counts(part))
            if sum(map(len, held)) > _HELD_ROWS:
                held = [_merged(held)]
                if len(held[0]) > _HELD_ROWS // 2:
                    yield from held.pop().to_batches()
    if held:
        yield from _merged(held).to_batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents); a row with a null term for every group."""
    read = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    partial = mapped(read, _partial_counts, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- divergences ----------------------------------------------------------------------------------------


def _chance(count: str, total: str) -> Column:
    """p of a count among ``total``, in decimals, as the product passes 64 bits; null where no term is kept."""
    share = f"(cast({count} + 1 as decimal(20, 0)) * {SCALE}BD) div cast({total} + kept as decimal(20, 0))"
    return F.expr(f"CASE WHEN kept > 0 THEN 1 + {share} END")


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pair_sums(own: np.ndarray, zero: np.ndarray, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Divergence of each own source from every source, summed over the terms of a shard.

    ``zero``: each source's chance of a count of zero; the rest are the cells with a count, sorted by row (term). A pair of
    zeros costs nothing per term: the sum for zeros is corrected where one of the two has a count.
    """
    n_terms = int(rows[-1]) + 1 if len(rows) else 0
    flat = _apart(zero[own][:, None], zero[None, :])
    sums = flat * n_terms
    step = max(1, _BLOCK_CELLS // len(zero))
    for first in range(0, n_terms, step):
        a, b = np.searchsorted(rows, [first, first + step])
        block = np.repeat(zero[None, :], min(step, n_terms - first), axis=0)
        block[rows[a:b] - first, columns[a:b]] = values[a:b]
        counted = block != zero
        for i, source in enumerate(own.tolist()):
            here = block[counted[:, source]]
            sums[i] += (_apart(here[:, source : source + 1], here) - _apart(zero[source], here)).sum(axis=0)
        cell, column = np.nonzero(counted)
        for i, source in enumerate(own.tolist()):
            changed = _apart(zero[source], block[cell, column]) - flat[i, column]
            np.add.at(sums[i], column, changed)
    return sums


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums (lang, source, item, value) of each shard: first come its sources (no term), then its cells by term."""
    for unit in runs(batches, ["lang", "shard", "tile"]):
        n = unit["term"].null_count
        sources = unit["source"].slice(0, n).combine_chunks()
        own = np.flatnonzero(unit["own"].slice(0, n).to_numpy())
        zero = unit["p"].slice(0, n).to_numpy()
        cells = unit.slice(n)
        terms = cells["term"].combine_chunks()
        new = np.ones(len(terms), dtype=np.int64)
        if len(terms):
            new[0] = 0
            new[1:] = pc.not_equal(terms.slice(1), terms.slice(0, len(terms) - 1)).to_numpy(zero_copy_only=False)
        columns = pc.index_in(cells["source"], value_set=sources).to_numpy()
        sums = _pair_sums(own, zero, np.cumsum(new) if len(new) else new, columns, cells["p"].to_numpy())
        lang = unit["lang"][0].as_py()
        for i, source in enumerate(own.tolist()):
            same = pa.array([lang] * n, pa.string()), pa.array([sources[source].as_py()] * n, pa.string())
            found = pa.RecordBatch.from_arrays([*same, sources, pa.array(sums[i])], names=["lang", "source", "item", "value"])
            yield found.filter(pa.array(np.arange(n) != source))


def _pairs(cells: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item (another source) and value."""
    tiles = F.ceil(F.count("*").over(Window.partitionBy("lang")) / TILE).cast("int")
    shards = F.greatest(F.lit(1), F.ceil(F.col("cells") / SHARD_CELLS)).cast("int")
    sized = stored(totals.withColumn("tiles", tiles).withColumn("shards", shards).withColumn("zero", F.coalesce(_chance("0", "total"), F.lit(1))))
    tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")
    shard = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    own = F.pmod(F.xxhash64("source"), F.col("tiles")) == F.col("tile")
    there = sized.select("lang", "source", "shards", "tiles", "zero", tile).select("*", shard)
    there = there.select("lang", "shard", "tile", F.lit(None).cast("string").alias("term"), "source", F.col("zero").alias("p"), own.alias("own"))
    counted = cells.where("term IS NOT NULL AND n > 0").join(sized.select("lang", "source", "total", "kept", "shards", "tiles"), ["lang", "source"])
    dealt = counted.select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), tile, "term", "source", _chance("n", "total").alias("p"), F.lit(False).alias("own"))
    both = there.unionByName(dealt).repartition("lang", "shard", "tile")
    read = both.sortWithinPartitions("lang", "shard", "tile", "term", "source")
    sums = mapped(read, _shards, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergences(docs: DataFrame, least_docs: int = 3, ranks: int = 200) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair``: the divergence of a source's terms from those of each other source (item), summed over the kept terms.
    Part ``term``: the ``ranks`` terms (item) that a source has more often than its language, by divergence. Equal values
    are ranked by item.
    """
    in_lang = Window.partitionBy("lang", "term")
    counts = term_counts(docs).select(
        "lang",
        "source",
        "term",
        "n",
        F.sum("n").over(in_lang).alias("lang_n"),
        F.sum("docs").over(in_lang).alias("lang_docs"),
        (F.min("source").over(in_lang) == F.col("source")).alias("first"),  # one cell of each term
    )
    cells = stored(counts.where(F.col("term").isNull() | (F.col("lang_docs") >= least_docs)))
    first = F.sum((F.col("term").isNotNull() & F.col("first")).cast("long"))
    per_source = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), first.alias("firsts"), F.count("term").alias("own_cells"))
    over_lang = Window.partitionBy("lang")
    kept, lang_total = F.sum("firsts").over(over_lang), F.sum("total").over(over_lang)
    in_all = [kept.alias("kept"), lang_total.alias("lang_total"), F.sum("own_cells").over(over_lang).alias("cells")]
    totals = stored(per_source.select("lang", "source", "total", *in_all))
    chances = cells.where("term IS NOT NULL AND n > 0").join(totals, ["lang", "source"])
    told = chances.select("lang", "source", F.col("term").alias("item"), _chance("n", "total").alias("p"), _chance("lang_n", "lang_total").alias("q"))
    terms = told.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(cells, totals).withColumn("rank", F.row_number().over(order))
    best = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    columns = [F.lit("pair").alias("part"), F.lit("term").alias("part")]
    parts = [d.select("lang", "source", part, "item", "value", "rank") for d, part in zip((pairs, best), columns)]
    return parts[0].unionByName(parts[1])


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT lang, source, row_id, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counted USING (lang, source) GROUP BY lang, source),
chances AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.lang_n + 1) // (l.lang_total + l.v) AS q
  FROM totals g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM chances a JOIN chances b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM chances WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
