"""Fingerprints from content-defined chunks.

*Boundaries.* A gear hash rolls over the UTF-8 bytes: each byte shifts the hash left by one and adds the byte's entry of a
mixing table, so it depends on the last 32 bytes only. A chunk ends where the top bits of the hash are zero. The
cut is normalised: below ``NORMAL`` bytes more bits have to be zero, from there on fewer, so sizes
gather around the normal one; no chunk is shorter than ``LEAST`` (but the last) or longer than ``MOST``.

*Digests.* A chunk's digest is a polynomial hash of its bytes, read from running sums, cut to ``DIGEST_BITS``. An
inserted passage shifts the bytes behind it but not the content that sets their boundaries, so digests come back.

*Fingerprint.* The set of the (digest, length) pairs, sorted, eight base64 characters each. Containment of a in b is
the length of a's chunks that b has, over the length of all of a's chunks.

The edited text of a document takes its end from the next document by ascending doc_id, after the last one from the
first. Rows are dealt by ranges of doc_id; the first row of each range also travels to the range before it, so
each text is shuffled once. Null doc_ids come first; repeated rows follow each other. Empty texts have the empty
fingerprint: two of them are alike (1), an empty one and another are not (0).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import mapped, mixed, whole_texts

LEAST, NORMAL, MOST = 16, 48, 192
STRICT_BITS, LOOSE_BITS = 7, 4
DIGEST_BITS, LENGTH_BITS = 40, 8

_WINDOW = 32
_BASE = np.uint64(0x5851F42D4C957F2D)


@cache
def _gear() -> np.ndarray:
    return (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


@cache
def _letters() -> np.ndarray:
    return mixed(np.arange(1001, 1257, dtype=np.uint64))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, modulo 2^64, of the inverse of the base and of the base."""
    powers = []
    for base in (pow(int(_BASE), -1, 1 << 64), int(_BASE)):
        row = np.full(n, base, dtype=np.uint64)
        row[0] = 1
        powers.append(np.cumprod(row, dtype=np.uint64))
    return powers[0], powers[1]


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, by doubling the window: h(2w)[i] = h(w)[i] + (h(w)[i - w] << w)."""
    rolled = _gear()[data]
    width = 1
    while width < _WINDOW:
        if len(rolled) <= width:
            break
        wider = rolled.copy()
        wider[width:] += rolled[:-width] << np.uint32(width)
        rolled, width = wider, width * 2
    return rolled


def boundaries(data: np.ndarray) -> np.ndarray:
    """Ends (exclusive) of the chunks of one text."""
    rolled = gear_hashes(data)
    loose = np.flatnonzero(rolled < np.uint32(1 << (32 - LOOSE_BITS))) + 1
    strict = (loose[rolled[loose - 1] < np.uint32(1 << (32 - STRICT_BITS))]).tolist()
    loose = loose.tolist()
    ends, start, n, a, b = [], 0, len(data), 0, 0
    while n - start > LEAST:
        first, normal, last = start + LEAST, start + NORMAL, min(start + MOST, n)
        while a < len(strict) and strict[a] < first:
            a += 1
        if a < len(strict) and strict[a] < normal:
            start = strict[a]
        else:
            while b < len(loose) and loose[b] < normal:
                b += 1
            start = loose[b] if b < len(loose) and loose[b] < last else last
        ends.append(start)
    if start < n:
        ends.append(n)
    return np.array(ends, dtype=np.int64)


def chunk_set(text: bytes) -> np.ndarray:
    """The distinct (digest << LENGTH_BITS | length) numbers of a text's chunks, sorted."""
    data = np.frombuffer(text, dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    ends = boundaries(data)
    down, up = _powers(1 << max(16, (len(data) - 1).bit_length()))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_letters()[data] * down[: len(data)], dtype=np.uint64)])
    starts = np.concatenate([np.zeros(1, dtype=np.int64), ends[:-1]])
    # the start's power takes the place out of the digest
    digests = mixed((sums[ends] - sums[starts]) * up[starts])
    lengths = (ends - starts).astype(np.uint64)
    return np.unique((digests >> np.uint64(64 - DIGEST_BITS) << np.uint64(LENGTH_BITS)) | lengths)


def written(chunks: np.ndarray) -> str:
    """A chunk set as text: eight base64 characters per chunk."""
    raw = chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.b64encode(raw.tobytes()).decode()


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of a's chunk bytes that are also chunks of b."""
    if not len(a):
        return 1.0 if not len(b) else 0.0
    weight = a & np.uint64((1 << LENGTH_BITS) - 1)
    return float(weight[np.isin(a, b, assume_unique=True)].sum() / weight.sum())


def edited(text: str, following: str) -> str:
    """The last quarter of a text's code points, replaced by the first as many (or all) of the text that follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _in_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text, place (a tie-break) and range: the number of the range of doc_ids that the row lies in; and how
    many ranges there are."""
    texts = whole_texts(docs).withColumn("place", F.xxhash64("text"))
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("double").alias("id")).where("id is not null")
    cuts = sorted(set(ids.approxQuantile("id", [i / n for i in range(1, n)], 0.4 / n))) or [0.0]
    number = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    ranges = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="id", outputCol="range")
    return ranges.transform(texts.withColumn("id", number)).drop("id"), len(cuts) + 1


def _with_guests(rows: DataFrame) -> DataFrame:
    """The rows, and the first row of each range once more as the guest at the end of the range before it.

    What reaches the driver is one line per range.
    """
    spark = rows.sparkSession
    first = F.min(F.struct("doc_id", "place")).alias("first")
    firsts = rows.groupBy("range").agg(first).select("range", "first.*").orderBy("range").collect()
    kind = rows.select("range", "doc_id", "place").schema.add("host", "double")
    hosts = [firsts[i - 1]["range"] for i in range(len(firsts))]
    wanted = spark.createDataFrame([(*row, host) for row, host in zip(firsts, hosts)], kind).toDF("r", "d", "p", "host")
    same = (F.col("range") == F.col("r")) & (F.col("place") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("d"))
    guests = rows.join(F.broadcast(wanted), same).dropDuplicates(["host"])
    guests = guests.select("doc_id", "text", "place", F.col("host").alias("range"), F.lit(True).alias("guest"))
    return rows.withColumn("guest", F.lit(False)).unionByName(guests)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, text, next text) of each own row; rows come sorted by range, with the guest last."""
    held = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text")]
        for at, guest, doc_id, text in zip(*columns):
            if held and held[0] == at:
                yield held[1], held[2], text
            held = None if guest else (at, doc_id, text)


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows: list[tuple] = []
    size = 0
    known: tuple[str, np.ndarray] | None = None
    for doc_id, text, following in _pairs(batches):
        own = known[1] if known and known[0] == text else chunk_set(text.encode())
        after = chunk_set(following.encode())
        changed = edited(text, following)
        other = own if changed == text else chunk_set(changed.encode())
        known = (following, after)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = containment(own, other), containment(own, after)
        rows.append((doc_id, len(text), digest, written(own), written(other), *near))
        size += len(text)
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and how far they and the next document's agree."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged, n = _in_ranges(docs)
    # neighbouring ranges share a partition, and every partition gets as many of them
    rows = _with_guests(ranged).repartitionById(partitions, F.floor(F.col("range") * partitions / n).cast("int"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(
        rows.sortWithinPartitions("range", "guest", "doc_id", "place"),
        _fingerprint_rows,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
