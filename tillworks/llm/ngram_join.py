"""Jaccard join on word n-grams by token-combination prefixes.

A token is a shingle of words, named by 64 bits mixed from the hashes of its words; a document is the set of its tokens.
Sets of x and y elements that share enough miss few: at least ``x - d`` tokens of the first are in the second, with
``d = floor((100 - percent) * x / 100)``.

*Order and classes.* All tokens have one order: rare ones first, then frequent ones, each by hash. Frequent are the tokens
whose slot in a table of ``SLOTS`` counts (a sketch over all documents, of fixed size) stands out. Rare tokens are one
class, in which k = 1; the frequent ones are cut into ranges of their order, each a class with k = 2.

*Prefixes.* A set's prefix is extended along the order until the sum of ``max(0, tokens - k + 1)`` over the classes passes
``d``. If two similar sets had fewer than k common tokens in each class of the shorter prefix, more than d tokens
would be missing; so some class has k of them, all of which lie in both prefixes. The index therefore holds every
single rare token and every pair of a frequent class in the prefix, and no similar pair is lost. The number of ranges goes
with the size of the set, so that a class has few tokens (sizes near a power of two are indexed for both sides).
Sets that can only be similar to equal ones need no index.

*Verifying.* ``set_links`` finds out, exactly, which sets reach each other by similar ones. Equal sets are one from the
start. Very frequent tokens spread over ``SALTS`` parts of their file, each with a hub of its own; the hubs meet the first one.

A null text is the empty one; without words the set is empty and linked with nothing; with fewer words than a shingle has
the whole sequence is the one token. Repeated rows share a part. Rows without a doc_id are joined like others; where
a whole part has no doc_id, component_id is null. An empty table gives no rows; other columns stay out. Two
different tokens of equal 64 bits, or sets of equal 128 bits, would be taken for one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import chosen_rows, data_bytes, mapped, mixed, text_slices, whole_texts
from tillworks.llm.set_links import FILE_ROWS, histogram, similar_parts
from tillworks.session import stored

SLOTS = 1 << 18
SALTS = 32
HUBS = 4  # tried first for each set

_SEEN = 200_000
_WORD = np.uint64(0x9E3779B97F4A7C15)
_RARE, _OFTEN, _HOT = 0, 1, 2


# --- sets of tokens -------------------------------------------------------------------------------------


def token_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct tokens of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    known = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    codes = coded.indices.to_numpy()
    doc = pc.list_parent_indices(split).to_numpy()
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:
        codes, doc = codes[codes != empty], doc[codes != empty]
    hashes = known[codes]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    tokens = hashes.copy()
    for k in range(1, words):
        tokens[: len(hashes) - k] = mixed(tokens[: len(hashes) - k] * _WORD + hashes[k:])
    found = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if b - a >= words:
            found.append(np.unique(tokens[a : b - words + 1]))
        elif a == b:
            found.append(tokens[:0])
        else:
            found.append(_short(hashes[a:b]))
    return found


def _short(hashes: np.ndarray) -> np.ndarray:
    """The one token of a text with fewer words than a shingle has."""
    token = mixed(np.array([len(hashes)], dtype=np.uint64))
    for h in hashes:
        token = mixed(token * _WORD + h)
    return token


def mark_of(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh128_digest(tokens.tobytes()) if len(tokens) else None


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(20)) & np.uint64(SLOTS - 1)


def _described(words: int):
    """A row per document (doc_id, n, mark, ranges), then the task's counts by slot (slot, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(SLOTS, dtype=np.int64), None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in text_slices(batch):
                sets = token_sets(part.column("text"), words)
                counts += np.bincount(np.concatenate([_slots(s) for s in sets]).astype(np.int64), minlength=SLOTS)
                columns = [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([mark_of(s) for s in sets], pa.binary()),
                    pa.array([histogram(s) if len(s) else None for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "mark", "ranges", "slot"])
        slots = np.flatnonzero(counts)
        if len(slots):
            none = pa.nulls(len(slots), pa.binary())
            columns = [pa.nulls(len(slots), kind), pa.array(counts[slots]), none, none, pa.array(slots.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "mark", "ranges", "slot"])

    return run


class FirstTime:
    """Whether a mark comes for the first time in this task; a bounded memory, so a copy may pass again."""

    def __init__(self):
        self.young, self.old = set(), set()

    def __call__(self, mark: bytes | None) -> bool:
        if mark is None or mark in self.young or mark in self.old:
            return False
        if len(self.young) >= _SEEN:
            self.young, self.old = set(), self.young
        self.young.add(mark)
        return True


def _elements(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = FirstTime()
        for batch in batches:
            for part in text_slices(batch):
                made = [(m, s.tobytes()) for s in token_sets(part.column("text"), words) if first(m := mark_of(s))]
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*made)], names=["mark", "elements"])

    return run


def elements_of(texts: DataFrame, info: DataFrame, words: int):
    """Gives (mark, elements) of asked marks; ``info`` names a document (first_id) of each, and only such texts are read."""

    def asked(marks: DataFrame) -> DataFrame:
        # of known size: Spark broadcasts a short list, a long one meets the texts in a shuffle
        wanted = stored(marks.join(info.select("mark", "first_id"), "mark"))
        rows = chosen_rows(texts, wanted.select("first_id").distinct())
        made = mapped(rows.select("text"), _elements(words), "mark binary, elements binary")
        return made.join(wanted.select("mark"), "mark", "left_semi").dropDuplicates(["mark"])

    return asked


# --- the index ------------------------------------------------------------------------------------------


def levels(n: int, percent: int) -> range:
    """The size levels (powers of two) of all sets that can be similar to one of n tokens."""
    return range((-(-percent * n // 100)).bit_length() - 1, (100 * n // percent).bit_length())


def index_keys(tokens: np.ndarray, classes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which a set is filed, and whether each stands for very frequent tokens. ``classes``: by slot."""
    n = len(tokens)
    missing = (100 - percent) * n // 100
    if missing == 0 and 100 * n // percent == n:  # only equal sets are similar
        return tokens[:0], np.zeros(0, dtype=bool)
    kinds = classes[_slots(tokens)]
    rare = tokens[kinds == _RARE][: missing + 1]
    if len(rare) > missing:
        return rare, np.zeros(len(rare), dtype=bool)
    often, hot = tokens[kinds != _RARE], kinds[kinds != _RARE] == _HOT
    keys, spread = [rare], [np.zeros(len(rare), dtype=bool)]
    for level in levels(n, percent):
        ranges = max(0, level - 2)  # bits
        part = often >> np.uint64(64 - ranges) if ranges else np.zeros(len(often), dtype=np.uint64)
        counted = np.append(False, part[1:] == part[:-1])  # in each class k - 1 = 1 token does not count
        stop = int(np.searchsorted(np.cumsum(counted), missing + 1 - len(rare))) + 1
        step = 1
        while step < stop:
            same = np.flatnonzero(part[: stop - step] == part[step:stop])
            if not len(same):
                break
            keys.append(mixed(mixed(often[same] + np.uint64(level + 1)) * _WORD + often[same + step]))
            spread.append(hot[same] & hot[same + step])
            step += 1
    return np.concatenate(keys), np.concatenate(spread)


def _indexed(words: int, percent: int, classes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = FirstTime()
        for batch in batches:
            for part in text_slices(batch):
                files, salts, marks = [], [], []
                for tokens in token_sets(part.column("text"), words):
                    mark = mark_of(tokens)
                    if first(mark):
                        keys, spread = index_keys(tokens, classes, percent)
                        files.append(keys)
                        salts.append(np.where(spread, 1 + mark[0] % SALTS, 0).astype(np.int32))
                        marks.extend([mark] * len(keys))
                if marks:
                    columns = [pa.array(np.concatenate(files).view(np.int64)), pa.array(np.concatenate(salts)), pa.array(marks, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "salt", "mark"])

    return run


_KEPT = pa.schema([("file", pa.int64()), ("salt", pa.int32()), ("mark", pa.binary()), ("hub", pa.binary())])


def _halves(marks: pa.Array) -> np.ndarray:
    """Marks, 16 bytes each, as rows of two numbers."""
    return data_bytes(marks).view(np.uint64).reshape(-1, 2)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, salt, mark, hub) of files with two sets and more, and of all salted ones; sorted rows, read once.

    The hub is the first mark of a file (or of its salted part). Its own row waits until a second set comes.
    """
    before = None  # the last row: file, salt, mark; the hub of its file; whether the hub's row has been told
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        files, salts, marks = batch.column("file").to_numpy(), batch.column("salt").to_numpy(), batch.column("mark")
        halves = _halves(marks)
        starts, other = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        starts[1:] = (files[1:] != files[:-1]) | (salts[1:] != salts[:-1])
        other[1:] = (halves[1:] != halves[:-1]).any(axis=1)
        goes_on = before is not None and (files[0], salts[0]) == before[:2]
        if goes_on:
            starts[0] = False
            other[0] = marks[0].as_py() != before[2]
        fresh = starts | other
        first = np.flatnonzero(starts)
        run = np.cumsum(starts) - 1  # -1: the run that goes on
        members = np.bincount(run[fresh & ~starts] + 1, minlength=len(first) + 1)  # besides the hub
        told = (members[1:] > 0) | (salts[first] > 0)
        keep = fresh & ~starts
        keep[first] = told
        if goes_on and members[0] and not before[4]:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*before[:2], before[3], before[3]), _KEPT)], schema=_KEPT)
        at = np.flatnonzero(keep)
        if len(at):
            hub_at = np.where(run[at] >= 0, first[np.maximum(run[at], 0)] if len(first) else 0, 0)
            hubs = marks.take(pa.array(hub_at))
            if goes_on and (run[at] < 0).any():
                hubs = pc.if_else(pa.array(run[at] < 0), pa.scalar(before[3], pa.binary()), hubs)
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*(rows.column(k).cast(f.type) for k, f in zip(("file", "salt", "mark"), _KEPT)), hubs.cast(pa.binary())], schema=_KEPT)
        if len(first):
            hub, hub_told = marks[int(first[-1])].as_py(), bool(told[-1])
        else:
            hub, hub_told = before[3], before[4] or bool(members[0])
        before = (files[-1], salts[-1], marks[n - 1].as_py(), hub, hub_told)


def _classes(told: DataFrame) -> np.ndarray:
    """Rare, frequent or very frequent, by slot: two limits on the sketch's counts, both in proportion to the documents."""
    slots = told.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(SLOTS, dtype=np.int64)
    for slot, n in slots.collect():  # SLOTS rows at most
        counts[slot] = n
    rows = told.where("slot IS NULL").count()
    often = max(8, 4 * counts.sum() // SLOTS, rows // 1000)
    return np.where(counts > max(often, rows // 50), _HOT, np.where(counts > often, _OFTEN, _RARE)).astype(np.uint8)


def joined_parts(docs: DataFrame, words: int, percent: int, file_rows: int = FILE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n, mark) and, per mark, its root (``similar_parts``) and first_id, its smallest doc_id."""
    if percent < 80:
        raise ValueError("prefixes are proven for 80 percent and more")
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    told = stored(mapped(texts, _described(words), f"doc_id {kind}, n long, mark binary, ranges binary, slot int"))
    rows = told.where("slot IS NULL").select("doc_id", "n", "mark", "ranges")
    one = rows.where("mark IS NOT NULL").groupBy("mark")
    info = stored(one.agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("ranges").alias("ranges")))
    keys = mapped(texts.select("text"), _indexed(words, percent, _classes(told)), "file long, salt int, mark binary")
    shared = shared_files(keys)
    sets = elements_of(texts, info, words)
    roots = similar_parts(shared.select("file", "mark"), first_hubs(shared), info.select("mark", "n", "ranges"), sets, percent, file_rows)
    return rows.select("doc_id", "n", "mark"), roots.join(info.select("mark", "first_id"), "mark")


def shared_files(keys: DataFrame) -> DataFrame:
    """Of rows (file, salt, mark) the files with two sets and more, each set once, with the hub of its (salted) file."""
    ordered = keys.repartition("file", "salt").sortWithinPartitions("file", "salt", "mark")
    return stored(mapped(ordered, _shared, "file long, salt int, mark binary, hub binary"))


def first_hubs(shared: DataFrame) -> DataFrame:
    """(mark, hub): up to ``HUBS`` hubs a set, those it meets in most files. A passage in common gives few files, a near copy many."""
    salted = shared.where("salt > 0").groupBy("file", "hub").agg(F.count("*").alias("n"))
    first = salted.groupBy("file").agg(F.min("hub").alias("first"), F.sum("n").alias("n")).where("n > 1")
    pairs = shared.select("mark", "hub").unionByName(salted.join(first.select("file", "first"), "file").select(F.col("hub").alias("mark"), F.col("first").alias("hub")))
    often = pairs.where("mark <> hub").groupBy("mark", "hub").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("mark").orderBy(F.desc("n"), "hub"))
    return stored(often.withColumn("place", place).where(F.col("place") <= HUBS).select("mark", "hub"))


def joined_documents(docs: DataFrame, words: int = 4, percent: int = 85, file_rows: int = FILE_ROWS) -> DataFrame:
    """doc_id, n_shingles (size of the set) and component_id (smallest doc_id reachable by links, itself included)."""
    rows, parts = joined_parts(docs, words, percent, file_rows)
    known = stored(parts)
    named = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_mark = known.join(named, "root").select("mark", "component_id", F.lit(True).alias("linked"))
    found = rows.join(by_mark, "mark", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
