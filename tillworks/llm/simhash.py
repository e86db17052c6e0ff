"""Near duplicates by SimHash, with pigeonring filtering of the candidates.

A fingerprint of D bits is cut into m segments that stand in a ring; ``d_i`` is the number of differing bits in
segment i. If two fingerprints differ in at most t bits, then there is a segment i from which every chain of l
segments (l = 1 .. m, around the ring) has at most l * t / m differences in total. Pairs without such a start are
dropped before the full Hamming check; no pair within t is lost.

*Few bits* (``fingerprint_groups``): m = t + 2 segments, so two segments at least are equal. Every distinct fingerprint
is filed under each pair of segments.

*Similar texts* (``similar_groups``): the same search runs over the fingerprints of the sets of shingles, and the texts of
fingerprints that it links share a file. At a similarity of 0.8 two 64-bit fingerprints differ in about ten bits, and segments
of so few bits tell nothing apart; so texts are filed under min-wise hashes of their shingles, too. Whatever file two texts
share, the sets of shingles judge: a distance of fingerprints is an estimate, and no limit on it is safe. Which sets reach each
other is found by ``set_links``, whose work grows in proportion to a group of near copies.

A file of fingerprints never gives all its pairs: its parts are searched breadth first, each member being compared with those that
no part has reached yet, and each linked member gives one row. A file of more than ``file_rows`` members is dealt over
pieces, and every two pieces are searched as a file of their own, so no pair is lost and no task holds more than
two pieces. Groups are connected components; no list of fingerprints, links or groups reaches the driver.

A null text is the empty one; texts without words have fingerprint zero and are linked like any other; fewer words than
a shingle has make one shingle. Repeated rows share a group. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import chosen_rows, mapped, mixed, text_slices, whole_texts
from tillworks.llm.ngram_join import FirstTime, elements_of, first_hubs, mark_of, shared_files, token_sets
from tillworks.llm.set_links import histogram, similar_parts
from tillworks.operators.components import connected_components
from tillworks.session import stored

SEED = 42
FILE_ROWS, SKETCH_ROWS = 20_000, 4_000
BANDS, BAND_ROWS = 28, 4

_SHINGLE_BLOCK = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALTS = mixed(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) << np.uint64(32))
_ONES = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)


# --- fingerprints of one text ---------------------------------------------------------------------------


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 of each word shingle of an ASCII-lower-cased text, in blocks; fewer words: of all of them; none: nothing."""
    found = text.lower().split()
    if not found:
        return
    line = b" ".join(found)
    ends = np.fromiter(accumulate(len(w) + 1 for w in found), dtype=np.int64, count=len(found)) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    starts, ends = starts[:n], ends[min(words, len(found)) - 1 :][:n]
    for at in range(0, n, _SHINGLE_BLOCK):
        spans = zip(starts[at : at + _SHINGLE_BLOCK].tolist(), ends[at : at + _SHINGLE_BLOCK].tolist())
        cut = [line[a:b] for a, b in spans]
        yield np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), dtype=np.uint64, count=len(cut))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit numbers have each bit, the highest bit first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, words: int) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the shingle hashes, repeats included."""
    total, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, words):
        total += _bit_counts(hashes)
        n += len(hashes)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big") if n else 0


def set_fingerprint(hashes: np.ndarray) -> int:
    """64-bit SimHash of a set of hashes, as a signed number."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SHINGLE_BLOCK):
        total += _bit_counts(hashes[at : at + _SHINGLE_BLOCK])
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big", signed=True)


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            marks = np.array([fingerprint(t.encode(), words) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks)], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return mapped(texts, _fingerprints(words), f"doc_id {kind}, fp long")


# --- the ring -------------------------------------------------------------------------------------------


def on_ring(differences: np.ndarray, bits: int) -> np.ndarray:
    """Whether each pair (a row of differing bits by segment) has a start whose every chain keeps within its budget."""
    segments = differences.shape[1]
    alive = np.ones(differences.shape, dtype=bool)
    chain = np.zeros(differences.shape, dtype=np.int32)
    for length in range(1, segments + 1):
        chain += np.roll(differences, 1 - length, axis=1)
        alive &= chain * segments <= length * bits
    return alive.any(axis=1)


class Members:
    """Members of a file: a row of ring segments each."""

    def __init__(self, parts: np.ndarray, bits: int):
        self.parts, self.bits = parts, bits

    def __len__(self) -> int:
        return len(self.parts)

    def close(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which others are close to one: the ring first, then the full distance."""
        differences = _set_bits(self.parts[others] ^ self.parts[one])
        close = on_ring(differences, self.bits)
        close[close] = differences[close].sum(axis=1) <= self.bits
        return close


def _roots(members: Members) -> np.ndarray:
    """Per member the first member of the part of the file it belongs to.

    Breadth first: a reached member is compared with the members that no part has reached, so a crowd of close
    copies costs little more than one look at each.
    """
    root = np.arange(len(members))
    left = np.arange(len(members))
    while len(left) > 1:
        seed, left = left[0], left[1:]
        waiting = [int(seed)]
        while waiting and len(left):
            close = members.close(waiting.pop(), left)
            reached = left[close]
            root[reached] = seed
            waiting.extend(reached.tolist())
            left = left[~close]
    return root


def _set_bits(numbers: np.ndarray) -> np.ndarray:
    """Set bits of each 64-bit number."""
    words = np.ascontiguousarray(numbers).view(np.uint16)
    return _ONES[words].reshape(*numbers.shape, 4).sum(axis=-1, dtype=np.int32)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each file that has two and more; rows come sorted by ``file``."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("file").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).tolist()
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != held_key:
                if sum(map(len, held)) > 1:
                    yield pa.Table.from_batches(held)
                held = []
            if b - a > 1 or held or b == len(keys):
                held_key = keys[a]
                held.append(batch.slice(a, b - a))
    if sum(map(len, held)) > 1:
        yield pa.Table.from_batches(held)


def _search(members_of):
    """Searches the files of a partition; ``members_of`` makes Members from a file's rows in the order of id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, n = [], [], 0
        for rows in _runs(batches):
            rows = rows.sort_by("id")
            ids = rows.column("id").to_numpy()
            root = _roots(members_of(rows))
            linked = root != np.arange(len(ids))
            if linked.any():
                us.append(ids[linked])
                vs.append(ids[root[linked]])
                n += int(linked.sum())
            if n > 50_000:
                yield _link_batch(us, vs)
                us, vs, n = [], [], 0
        if n:
            yield _link_batch(us, vs)

    return run


def _link_batch(us: list, vs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])


def _dealt(filed: DataFrame, file_rows: int) -> DataFrame:
    """id and file of the files with two members and more; crowded ones become a file for every two of their pieces."""
    sizes = filed.groupBy("file").agg(F.count("*").alias("n")).where("n > 1")
    pieces = F.ceil(F.col("n") / file_rows).cast("int")
    joined = filed.join(sizes, "file").withColumn("pieces", pieces)
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    dealt = joined.withColumn("own", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")).select("*", other.alias("other"))
    two = F.xxhash64("file", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select("id", F.when(F.col("pieces") > 1, two).otherwise(F.col("file")).alias("file"))


def _file_links(filed: DataFrame, members_of) -> DataFrame:
    """Links (u, v) that join the close members of each file. filed: id, file and what ``members_of`` reads."""
    partitions = int(filed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = filed.repartition(partitions, "file").sortWithinPartitions("file")
    return mapped(read, _search(members_of), "u long, v long")


# --- few bits -------------------------------------------------------------------------------------------


def _layout(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment of a 64-bit fingerprint."""
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _only(low: int, width: int):
    """The bits of one segment of fp."""
    value = ((1 << width) - 1) << low
    return F.col("fp").bitwiseAND(F.lit(value - (1 << 64) if value >> 63 else value))


def links(marks: DataFrame, bits: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """Links (u, v) that join all of the distinct fingerprints ``fp`` that lie within ``bits`` of each other."""
    layout = _layout(bits + 2)
    keys = [F.xxhash64(F.lit(n), _only(*a), _only(*b)) for n, (a, b) in enumerate(combinations(layout, 2))]
    filed = stored(marks.select(F.col("fp").alias("id"), F.explode(F.array(*keys)).alias("file")))

    def members(rows: pa.Table) -> Members:
        plain = rows.column("id").to_numpy().view(np.uint64)
        parts = [(plain >> np.uint64(low)) & np.uint64((1 << width) - 1) for low, width in layout]
        return Members(np.stack(parts, axis=1), bits)

    return _file_links(_dealt(filed, file_rows), members)


def fingerprint_groups(docs: DataFrame, words: int = 3, bits: int = 2, file_rows: int = FILE_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable.

    Rows without a doc_id form groups like others; component_id is null only where a whole group has none.
    """
    marked = stored(fingerprints(docs, words))
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows")))
    roots = connected_components(distinct.select(F.col("fp").alias("u")), links(distinct.select("fp"), bits, file_rows))
    parts = roots.join(distinct, roots["u"] == distinct["fp"])
    named = parts.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_mark = stored(parts.join(named, "root").select("fp", "component_id", "rows"))
    return _on_every_row(marked, by_mark).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _on_every_row(marked: DataFrame, by_mark: DataFrame) -> DataFrame:
    """Joins by fp. A fingerprint of very many rows is spread over pages."""
    total = by_mark.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    page_rows = max(1, -(-total // 1000))  # so no more than 1,000 fingerprints have pages
    pages = F.ceil(F.col("rows") / page_rows).cast("int")
    hot = by_mark.where(F.col("rows") > page_rows).select("fp", pages.alias("pages"))
    page = F.pmod(F.xxhash64("doc_id"), F.coalesce("pages", F.lit(1))).cast("int")
    dealt = marked.join(F.broadcast(hot), "fp", "left").withColumn("page", page).drop("pages")
    copies = by_mark.withColumn("page", F.explode(F.sequence(F.lit(0), pages - 1))).drop("rows")
    return dealt.join(copies, ["fp", "page"])


# --- similar texts --------------------------------------------------------------------------------------


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """The file keys of a set of 64-bit hashes, from its min-wise hashes."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), _SHINGLE_BLOCK):
        block = hashes[at : at + _SHINGLE_BLOCK]
        for i, salt in enumerate(_SALTS):
            least[i] = min(least[i], ((block ^ salt) * _STEP).min())
    keys = least.reshape(BANDS, BAND_ROWS)
    file = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_ROWS):
        file = mixed(file ^ keys[:, i])
    return file.view(np.int64)


def _sketches(words: int):
    """doc_id, n, mark (null without words), ranges, fp; and files where the mark comes for the first time in the task."""
    names = ["doc_id", "n", "mark", "ranges", "fp", "files"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = FirstTime()
        for batch in batches:
            for part in text_slices(batch):
                sets = token_sets(part.column("text"), words)
                marks = [mark_of(s) for s in sets]
                columns = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(marks, pa.binary()),
                    pa.array([histogram(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([set_fingerprint(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([band_keys(s) if first(m) else None for s, m in zip(sets, marks)], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    return run


def _files_by_fingerprint(info: DataFrame, bits: int) -> DataFrame:
    """Rows (file, salt, mark): a file for all sets whose fingerprints reach each other within ``bits``."""
    distinct = stored(info.select("fp").distinct())
    roots = connected_components(distinct.select(F.col("fp").alias("u")), links(distinct, bits)).toDF("fp", "root")
    return info.select("mark", "fp").join(roots, "fp").select(F.xxhash64(F.lit("fp"), "root").alias("file"), F.lit(0).alias("salt"), "mark")


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, file_rows: int = SKETCH_ROWS, bits: int = 2) -> DataFrame:
    """keep_id (the smallest doc_id of a group) and mark: one row per distinct set of shingles.

    Equal sets are one group, and so are the texts without words (mark null). Rows without a doc_id are not
    looked at. Two texts share a file if their fingerprints are within ``bits`` or a band of their min-wise hashes agrees; of a
    similarity of 0.8 they share none of the bands' files with a chance of 4e-7, of 0.9 with 1e-13; such a pair is
    linked only through others.
    """
    percent = round(100 * similarity)
    texts = whole_texts(docs).where("doc_id is not null")
    marked = stored(mapped(texts, _sketches(words), "doc_id long, n long, mark binary, ranges binary, fp long, files array<long>"))
    one = marked.where("mark IS NOT NULL").groupBy("mark")
    info = stored(one.agg(F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("n", "ranges", "fp")]))
    keys = marked.select(F.explode("files").alias("file"), F.lit(0).alias("salt"), "mark")
    shared = shared_files(keys.unionByName(_files_by_fingerprint(info, bits)))
    sets = elements_of(texts, info, words)
    roots = similar_parts(shared.select("file", "mark"), first_hubs(shared), info.select("mark", "n", "ranges"), sets, percent, file_rows)
    known = stored(roots.join(info.select("mark", "first_id"), "mark"))
    least = known.groupBy("root").agg(F.min("first_id").alias("keep_id"))
    wordless = marked.where("mark IS NULL").agg(F.min("doc_id").alias("keep_id")).where("keep_id IS NOT NULL")
    return known.join(least, "root").select("keep_id", "mark").unionByName(wordless.select("keep_id", F.lit(None).cast("binary").alias("mark")))


def one_of_each_group(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of similar texts, that with the smallest doc_id; rows without doc_id stay."""
    kept = similar_groups(docs, words, similarity).select("keep_id").distinct()
    return chosen_rows(docs, kept.unionByName(docs.sparkSession.range(1).select(F.lit(None).cast("long").alias("keep_id"))))
