"""Which sets of shingles reach each other by similar ones, given files of sets that may be similar.

A set is named by ``mark``, the digest of its elements, so equal sets are one. ``filed`` says which sets share a file;
every similar pair shares at least one. Only the parts that the links make are asked for, so no file gives all its pairs:

*Stars.* Every set is compared with some hubs, the first marks of files it is in, those first that it meets in most files.
Most of a crowd of near copies is settled by that: a member is looked at a few times, whatever the crowd's size. What is linked gets
one label.

*Rest.* A file whose members have one label by now says nothing new. In each other one (files of the same members count
once) every pair of different labels is looked at: first by sizes and histograms of about a byte for 8 elements, which pass over
most pairs and lose none, then by the sets. Few partners of a member are told as pairs, each pair once for all files; where a
member has more of them, all files that overlap become one, in which each set is shipped once. A crowded file is
dealt over tasks: the members of its most frequent label stay where they are, in pieces, and the others come to each piece.

A histogram counts the elements by range of hashes. Similar sets differ in no more than (100 - percent) / (100 +
percent) of the sum of their sizes, so histograms that differ in more are not those of similar sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import mapped, runs
from tillworks.operators.components import connected_components
from tillworks.session import stored

FILE_ROWS = 4_000
RANGES = 128
FEW = 32  # a member with more partners to look at has them looked at where its file is,
SMALL = 4  # members of a file whose few pairs are told at once
TRIED = 8  # after so many of them have been tried as pairs, the same ones in all files
_BLOCK = 2_048


def histogram(elements: np.ndarray) -> bytes:
    """Elements (64-bit hashes) per range, 255 at most: what is cut off only makes histograms more alike.

    There are ``RANGES`` ranges, and twice as many as long as a range would hold more than 8 elements on average.
    """
    level = max(0, (len(elements) - 1) // (8 * RANGES)).bit_length()
    counts = np.bincount(elements >> np.uint64(57 - level), minlength=RANGES << level)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _folded(ranges: np.ndarray, times: int) -> np.ndarray:
    """Histograms (rows) with half as many ranges, so many times."""
    for _ in range(times):
        ranges = np.minimum(ranges[:, 0::2].astype(np.int16) + ranges[:, 1::2], 255)
    return ranges


def similar(shared: np.ndarray, sizes: np.ndarray, size: int, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (sizes + size - shared)


def _fit(sizes: np.ndarray, size, percent: int) -> np.ndarray:
    return 100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size)


def _alike(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether histograms (rows) may be those of similar sets; ``sizes``: sums of both sizes."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16)).sum(axis=1, dtype=np.int64)
    return (100 + percent) * apart <= (100 - percent) * sizes


def _levels(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """How often each histogram's ranges have been doubled."""
    return np.log2(np.asarray(pc.binary_length(column)) // RANGES).astype(np.int64)


def _histograms(column: pa.ChunkedArray | pa.Array, level: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=np.uint8).reshape(-1, RANGES << level)


# --- stars ----------------------------------------------------------------------------------------------


def _probable(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, hub_n = batch.column("n").to_numpy(), batch.column("hub_n").to_numpy()
                found = _fit(n, hub_n, percent)
                one, two = _levels(batch.column("ranges")), _levels(batch.column("hub_ranges"))
                for a, b in set(zip(one.tolist(), two.tolist())):
                    at = np.flatnonzero(found & (one == a) & (two == b))
                    rows = batch.take(pa.array(at))
                    mine, hubs = _histograms(rows.column("ranges"), a), _histograms(rows.column("hub_ranges"), b)
                    m = min(a, b)
                    found[at] = _alike(_folded(mine, a - m), _folded(hubs, b - m), (n + hub_n)[at], percent)
                yield batch.select(["mark", "hub"]).filter(pa.array(found))

    return run


def _verified(percent: int):
    """Members similar to their hub; in each piece the hub's row comes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            marks, hubs = batch.column("mark").to_pylist(), batch.column("hub").to_pylist()
            close = np.zeros(len(marks), dtype=bool)
            for i, (mark, hub, elements) in enumerate(zip(marks, hubs, batch.column("elements"))):
                found = np.frombuffer(elements.as_buffer(), dtype=np.uint64)
                if mark == hub:
                    own = found
                else:
                    at = np.minimum(np.searchsorted(own, found), len(own) - 1)
                    close[i] = similar((own[at] == found).sum(), np.int64(len(own)), len(found), percent)
            yield batch.select(["mark", "hub"]).filter(pa.array(close)).rename_columns(["u", "v"])

    return run


def _likely(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (mark, hub) that sizes and histograms do not rule out."""
    hub_info = info.select(F.col("mark").alias("hub"), F.col("n").alias("hub_n"), F.col("ranges").alias("hub_ranges"))
    told = pairs.join(info, "mark").join(hub_info, "hub")
    return mapped(told.select("mark", "hub", "n", "hub_n", "ranges", "hub_ranges"), _probable(percent), "mark binary, hub binary")


def _compared(pairs: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, file_rows: int) -> DataFrame:
    """Those of the pairs (mark, hub) that are similar, as links (u, v); a hub's pairs are dealt over pieces."""
    pieces = pairs.groupBy("hub").agg(F.ceil(F.count("*") / file_rows).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("mark"), F.col("pieces")).cast("int").alias("piece")
    members = pairs.join(pieces, "hub").select("mark", "hub", piece)
    copies = pieces.select(F.col("hub").alias("mark"), "hub", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    asked = stored(members.unionByName(copies))
    shipped = asked.join(sets(asked.select("mark").distinct()), "mark")
    read = shipped.repartition("hub", "piece").sortWithinPartitions("hub", "piece", F.col("mark") != F.col("hub"))
    return mapped(read.select("mark", "hub", "elements"), _verified(percent), "u binary, v binary")


# --- rest -----------------------------------------------------------------------------------------------


def dealt(rows: DataFrame, file_rows: int) -> DataFrame:
    """Rows (file, mark, label) with their unit (file, a, b) and their side in it.

    A file of up to ``file_rows`` members is one unit (side 0: all labels meet). Of a larger one, pieces of the most
    frequent label (side 1) meet chunks of the others (side 2), and chunks of the others meet each other.
    """
    labels = rows.groupBy("file", "label").agg(F.count("*").alias("c"))
    sizes = labels.groupBy("file").agg(F.sum("c").alias("n"), F.max(F.struct("c", "label")).alias("top"))
    known = rows.join(sizes.where(F.col("n") > file_rows), "file", "left")
    small = known.where("n IS NULL").select(*rows.columns, F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("side"))
    pieces = F.ceil(F.col("top.c") / file_rows).cast("int")
    chunks = F.ceil((F.col("n") - F.col("top.c")) / file_rows).cast("int")
    large = known.where("n IS NOT NULL").withColumns({"pieces": pieces, "chunks": chunks, "hash": F.xxhash64("mark")})
    mine = large.where("label = top.label").withColumn("a", F.pmod("hash", "pieces").cast("int"))
    mine = mine.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("side", F.lit(1))
    other = large.where("label <> top.label").withColumn("own", F.pmod("hash", "chunks").cast("int"))
    meeting = other.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("b", F.col("own"))
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    among = other.withColumn("second", every).withColumn("a", -1 - F.least("own", "second")).withColumn("b", F.greatest("own", "second"))
    columns = [*rows.columns, "a", "b", "side"]
    found = mine.select(columns).unionByName(meeting.withColumn("side", F.lit(2)).select(columns))
    return small.unionByName(found).unionByName(among.withColumn("side", F.lit(0)).select(columns))


class _Unit:
    """The members of one unit, by size."""

    def __init__(self, rows: pa.Table, percent: int):
        self.percent = percent
        self.rows = rows.sort_by("n")
        self.sizes = self.rows["n"].to_numpy()
        self.sides = self.rows["side"].to_numpy()
        self.labels = self.rows["label"].combine_chunks().dictionary_encode().indices.to_numpy().copy()
        ranges = self.rows["ranges"].combine_chunks()
        self.levels, self.row, self.ranges = _levels(ranges), np.zeros(len(rows), dtype=np.int64), {}
        for level in set(self.levels.tolist()):
            at = np.flatnonzero(self.levels == level)
            self.row[at], self.ranges[level] = np.arange(len(at)), _histograms(ranges.take(pa.array(at)), level)

    def askers(self) -> np.ndarray:
        """Members that ask all others: of every pair of unlike labels at least one is among them."""
        if self.sides.any():
            return np.flatnonzero(self.sides == (1 if (self.sides == 1).sum() < (self.sides == 2).sum() else 2))
        return np.flatnonzero(self.labels != np.bincount(self.labels).argmax())

    def partners(self, i: int, labels: np.ndarray) -> np.ndarray:
        """Members of other labels that may be similar to member i."""
        n, s = int(self.sizes[i]), self.percent
        a, b = np.searchsorted(self.sizes, [-(-s * n // 100), 100 * n // s + 1])
        at = np.arange(a, b)
        at = at[(labels[a:b] != labels[i]) & ((self.sides[a:b] == 0) | (self.sides[a:b] != self.sides[i]))]
        mine, own = self.ranges[self.levels[i]][self.row[i]][None, :], int(self.levels[i])
        near = []
        for level in set(self.levels[at].tolist()):
            m, members = min(own, level), at[self.levels[at] == level]
            asked = _folded(mine, own - m)
            for k in range(0, len(members), _BLOCK):
                x = members[k : k + _BLOCK]
                theirs = _folded(self.ranges[level][self.row[x]], level - m)
                near.append(x[_alike(theirs, asked, self.sizes[x] + n, s)])
        return np.sort(np.concatenate(near)) if near else at


def _left_over(percent: int, few: int):
    """What sizes and histograms do not rule out: the pairs (mark, hub) of members with few partners of other labels, and
    the members (file, mark) of files in which one has more, with the first few pairs of that one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["file", "a", "b"]):
            unit = _Unit(rows, percent)
            crowded, us, vs = np.zeros(len(rows), dtype=bool), [], []
            files, marks = unit.rows["file"].combine_chunks(), unit.rows["mark"].combine_chunks()
            order = np.argsort(np.argsort(np.array(marks.to_pylist(), dtype="S16")))
            for i in unit.askers().tolist():
                found = unit.partners(i, unit.labels)
                if len(found) > few:
                    crowded[found] = crowded[i] = True
                    found = found[np.argsort(order[found])[:TRIED]]
                us.extend([i] * len(found))
                vs.extend(found.tolist())
            if us:
                one, two = (marks.take(pa.array(x)).to_pylist() for x in (us, vs))
                pairs = [pa.array([f(p) for p in zip(one, two)], pa.binary()) for f in (max, min)]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(us), pa.int64()), *pairs], names=["file", "mark", "hub"])
            if crowded.any():
                at = pa.array(np.flatnonzero(crowded))
                none = pa.nulls(len(at), pa.binary())
                yield pa.RecordBatch.from_arrays([files.take(at), marks.take(at), none], names=["file", "mark", "hub"])

    return run


def _cross_links(percent: int):
    """Links (u, v) of labels that have similar members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["file", "a", "b"]):
            unit = _Unit(rows, percent)
            sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in unit.rows["elements"].combine_chunks()]
            names = unit.rows["label"].combine_chunks()
            parts, us, vs = unit.labels.copy(), [], []
            for i in unit.askers().tolist():
                found = unit.partners(i, parts)
                while len(found):
                    j, found = int(found[0]), found[1:]
                    at = np.minimum(np.searchsorted(sets[i], sets[j]), len(sets[i]) - 1)
                    if similar((sets[i][at] == sets[j]).sum(), np.int64(len(sets[j])), len(sets[i]), percent):
                        us.append(i)
                        vs.append(j)
                        found = found[parts[found] != parts[j]]
                        parts[parts == parts[j]] = parts[i]
            if us:
                yield pa.RecordBatch.from_arrays([names.take(pa.array(us)), names.take(pa.array(vs))], names=["u", "v"])

    return run


def _one_each(rows: DataFrame) -> DataFrame:
    """The smallest of the files that have the same members, with their number (size); the members are told by it and two digests."""
    told = [F.count("*").alias("n"), F.sum(F.xxhash64("mark").cast("decimal(38, 0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "mark")).alias("x")]
    open_files = rows.groupBy("file").agg(F.min("label").alias("least"), F.max("label").alias("most"), *told).where("least <> most")
    first = open_files.groupBy("n", "s", "x").agg(F.min("file").alias("file"))
    return rows.join(first.select("file", F.col("n").alias("size")), "file")


def _small_pairs(rows: DataFrame) -> DataFrame:
    """The pairs (mark, hub) of different labels in files of up to ``SMALL`` members, each once."""
    members = rows.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("mark", "label"))).alias("m"))
    each = F.transform("m", lambda a: F.transform(F.filter("m", lambda b: (b["mark"] < a["mark"]) & (b["label"] != a["label"])), lambda b: F.struct(a["mark"].alias("mark"), b["mark"].alias("hub"))))
    return members.select(F.explode(F.flatten(each)).alias("pair")).select("pair.mark", "pair.hub").distinct()


def _crowds(crowded: DataFrame) -> DataFrame:
    """Files that overlap as one file, so that a set that is in very many of them is shipped once."""
    rows = stored(crowded)
    first = rows.groupBy("file").agg(F.min("mark").alias("v"))
    edges = rows.join(first, "file").select(F.col("mark").alias("u"), "v").distinct()
    found = connected_components(rows.select(F.col("mark").alias("u")).distinct(), edges)
    return found.select(F.xxhash64("root").alias("file"), F.col("u").alias("mark"))


def _rest(filed: DataFrame, labels: DataFrame, info: DataFrame, sets, percent: int, file_rows: int) -> DataFrame:
    """Links (u, v) of labels."""
    named = filed.select("file", "mark").join(labels, "mark")
    told = stored(named)
    rows = stored(_one_each(told))  # several frames are built on it: no join may be left to run in each of them
    few = _likely(_small_pairs(rows.where(F.col("size") <= SMALL)), info, percent)
    units = dealt(rows.where(F.col("size") > SMALL).drop("size"), file_rows).join(info, "mark")
    read = units.repartition("file", "a", "b").sortWithinPartitions("file", "a", "b")
    left = stored(mapped(read, _left_over(percent, FEW), "file long, mark binary, hub binary").distinct())
    found_pairs = left.where("file IS NULL").select("mark", "hub").unionByName(few).distinct()
    pairs = _compared(stored(found_pairs), sets, percent, file_rows)
    named = pairs.join(labels.toDF("u", "label_u"), "u").join(labels.toDF("v", "label_v"), "v")
    found = stored(named.where("label_u <> label_v").select(F.col("label_u").alias("u"), F.col("label_v").alias("v")).distinct())
    crowded = left.where("file IS NOT NULL").select("file", "mark")
    if crowded.isEmpty():
        return found
    # crowds: what the pairs have linked has one label by now; histograms come along with the sets, as both are looked at
    parts = connected_components(labels.select(F.col("label").alias("u")).distinct(), found).toDF("label", "part")
    members = _crowds(crowded).join(labels, "mark").join(parts, "label")
    crowds = stored(_one_each(members.select("file", "mark", F.col("part").alias("label"))).drop("size"))
    with_sets = dealt(crowds, file_rows).join(sets(crowds.select("mark").distinct()), "mark").join(info, "mark")
    read = with_sets.repartition("file", "a", "b").sortWithinPartitions("file", "a", "b")
    crossed = mapped(read, _cross_links(percent), "u binary, v binary")
    return crossed.unionByName(found).distinct()


def similar_parts(filed: DataFrame, hubs: DataFrame, info: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """mark and root, which sets have in common that reach each other by similar ones; of all sets in ``info``.

    ``filed``: (file, mark), each once; ``hubs``: (mark, hub), pairs to look at first; ``info``: (mark, n, ranges) with the
    size and ``histogram`` of every set; ``sets``: gives (mark, elements) of asked marks, elements being sorted
    64-bit hashes; ``percent``: similar sets share so much of their union.
    """
    linked = stored(_compared(stored(_likely(hubs, info, percent)), sets, percent, file_rows))
    labels = stored(connected_components(info.select(F.col("mark").alias("u")), linked).toDF("mark", "label"))
    crossed = stored(_rest(filed, labels, info, sets, percent, file_rows))
    roots = connected_components(labels.select(F.col("label").alias("u")).distinct(), crossed).toDF("label", "root")
    return labels.join(roots, "label").select("mark", "root")
