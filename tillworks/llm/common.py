"""Small helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.session import mapped as mapped  # the operators take it from here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_texts(docs: DataFrame) -> DataFrame:
    """Only doc_id and text; a null text counts as the empty one. Other columns, whatever their names, stay out."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def chosen_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids`` (one column), with their own columns only."""
    wanted = ids.toDF("__wanted_doc_id")
    return docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["__wanted_doc_id"]), "left_semi")


def text_slices(batch: pa.RecordBatch, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch by the bytes of its texts, so that what is built per slice stays small; a row is never cut."""
    sizes = np.cumsum(np.diff(np.frombuffer(offsets(batch.column("text")), dtype=np.int64)))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal keys, one table per run; rows come sorted by the keys, which are not null."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        changes = np.zeros(n - 1, dtype=bool)
        for k in keys:
            column = batch.column(k)
            changes |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False).astype(bool)
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            held.append(batch.slice(a, b - a))
            if b < n:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets of each text in the array's data buffer, one more than there are texts."""
    wide = pa.types.is_large_string(texts.type)
    raw = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def data_bytes(texts: pa.Array) -> np.ndarray:
    """The UTF-8 bytes of all texts of the array, one after the other."""
    at = offsets(texts)
    buffer = texts.buffers()[2]
    if buffer is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8)
    return np.frombuffer(buffer, dtype=np.uint8)[at[0] : at[-1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift, xor) applied to each number."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
