"""Packs examples into sequences as vector bin packing.

Every example is a vector: its tokens, one segment, and its loss-bearing tokens. A sequence has a limit for each. The
next example for an open sequence is the one whose vector has the largest dot product with what is left of the
limits (both as shares of the limits): large demands go where there is room for just these. If none of the waiting
examples fits as a whole, the best one is cut so that it fills the sequence: cuts are free, and a sequence that has
segments left is always filled. What is over at the end of a partition goes to sequences whose lengths are powers of
two, which need no padding.

Packing needs no shuffle: each partition packs its own rows, from a pool of a bounded number of examples. Sequence ids
hold the partition in their upper bits, so they are unique; they repeat as long as the partitions do.

A null text is the empty one: its only token is the end mark. Rows with a null doc_id, repeated rows and ties are
packed like all others (a piece carries its row's doc_id). An empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import mapped, text_slices, whole_texts
from tillworks.llm.word_ids import WordIds

TOKENS, SEGMENTS, LOSS = 4096, 256, 4096
END_ID = 2
POOL = 256


@dataclass
class Example:
    """Ids of one example; the first ``quiet`` of them bear no loss. ``start`` is where the rest begins."""

    name: object
    ids: np.ndarray
    quiet: int = 0
    start: int = 0

    def left(self) -> int:
        return len(self.ids) - self.start

    def loss(self, n: int | None = None) -> int:
        """Loss-bearing tokens among the next n (or all that are left)."""
        end = len(self.ids) if n is None else self.start + n
        return max(0, end - max(self.start, self.quiet))

    def most(self, tokens: int, loss: int) -> int:
        """How many of the next ids fit."""
        free = max(0, self.quiet - self.start)
        return min(self.left(), tokens, free + loss)


class Packer:
    """Fills one sequence after the other. Pieces: (example, start, length, sequence, offset)."""

    def __init__(self, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS), pool: int = POOL):
        if min(limits) < 1:
            raise ValueError("every limit has to be at least 1")
        self.limits, self.pool, self.sequences = limits, pool, 0
        self.waiting: list[Example] = []
        self.vectors = np.zeros((2 * pool + 2 * limits[1] + 8, 3))  # of the waiting ones, in their order

    def add(self, example: Example) -> Iterator[tuple]:
        self._wait(example)
        while len(self.waiting) > self.pool:
            yield from self._sequence(self._filled(self.limits[0]))

    def finish(self) -> Iterator[tuple]:
        """Full sequences as long as there is enough, then sequences of ever smaller powers of two."""
        while self.waiting:
            left = sum(e.left() for e in self.waiting)
            yield from self._sequence(self._filled(min(self.limits[0], 1 << (left.bit_length() - 1))))

    def _wait(self, example: Example) -> None:
        if example.left():
            self.vectors[len(self.waiting)] = example.left(), 1, example.loss()
            self.waiting.append(example)

    def _filled(self, tokens: int) -> list[tuple[Example, int, int]]:
        """Takes examples out of the pool until ``tokens`` are reached or another limit is."""
        most = np.array([tokens, self.limits[1], min(self.limits[2], tokens)], dtype=np.float64)
        room, sizes = most.copy(), self.vectors[: len(self.waiting)]
        there = np.ones(len(sizes), dtype=bool)
        shares, taken, used = sizes / most, [], []
        while room[0] >= 1 and room[1] >= 1 and len(used) < len(sizes):
            fits = there & (sizes <= room).all(axis=1)
            scores = shares @ (room / most)
            scores[~(fits if fits.any() else there)] = -1.0
            pick = int(scores.argmax())
            there[pick] = False
            used.append(pick)
            example = self.waiting[pick]
            n = example.most(int(room[0]), int(room[2]))
            if n:  # else its next token bears loss and none is left: another one may begin without
                taken.append((example, example.start, n))
                room -= [n, 1, example.loss(n)]
                example.start += n
        for pick in sorted(used, reverse=True):
            example = self.waiting[pick]
            if example.left():
                self.vectors[pick] = example.left(), 1, example.loss()
            else:  # the last one moves to its place
                self.vectors[pick] = self.vectors[len(self.waiting) - 1]
                self.waiting[pick] = self.waiting[-1]
                self.waiting.pop()
        return taken

    def _sequence(self, taken: list[tuple[Example, int, int]]) -> Iterator[tuple]:
        """Places the pieces; a sequence that a limit has left short is cut back to a power of two."""
        total = sum(n for _, _, n in taken)
        allowed = total if total == self.limits[0] else 1 << (total.bit_length() - 1)
        offset = 0
        for example, start, n in taken:
            n_here = min(n, allowed - offset)
            if n_here < n:  # the rest goes back
                self._wait(Example(example.name, example.ids[: start + n], example.quiet, start + n_here))
            if n_here:
                yield example, start, n_here, self.sequences, offset
                offset += n_here
        self.sequences += 1


def pack(examples: Iterator[Example], limits=(TOKENS, SEGMENTS, LOSS), pool: int = POOL) -> Iterator[tuple]:
    """Pieces (example, start, length, sequence, offset) of all the examples."""
    packer = Packer(limits, pool)
    for example in examples:
        yield from packer.add(example)
    yield from packer.finish()


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _packed(path: str, limits: tuple[int, int, int]):
    def examples(batches: Iterator[pa.RecordBatch], words: WordIds) -> Iterator[Example]:
        for batch in batches:
            for part in text_slices(batch):
                names = part.column("doc_id").to_pylist()
                for name, ids in zip(names, words.encode(part.column("text"), END_ID)):
                    yield Example((name, len(ids)), ids, quiet=1)  # nothing predicts the first token

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        first = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        for example, start, n, sequence, offset in pack(examples(batches, WordIds(path)), limits):
            crc = zlib.crc32(example.ids[start : start + n].astype("<u4").tobytes())
            name, tokens = example.name
            rows.append((name, start, n, crc, tokens, first + sequence, offset))
            if len(rows) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=_NAMES)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=_NAMES)

    return run


def packed_documents(docs: DataFrame, path: str, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS)) -> DataFrame:
    """One row per piece of a document's ids (the tokenizer's, then the end mark). ``path``: a tokenizers file."""
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    long_columns = ", ".join(f"{name} long" for name in _NAMES[1:])
    return mapped(texts, _packed(path, limits), f"doc_id {kind}, {long_columns}").select(
        "doc_id", *[F.col(name) for name in _NAMES[1:]]
    )
