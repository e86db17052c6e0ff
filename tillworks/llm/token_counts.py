"""Token counts of whole texts, as the sentencepiece library gives them, with a shortcut for whole tokens.

*Cutting.* The library writes every space as a mark and puts one before the text. In a vocabulary where no piece has
that mark behind another character (``separable`` checks it), no merge reaches across the border in front of a
run of marks. So the text falls into pre-tokens, a run of marks and what follows up to the next one, which are
merged independently, and their counts add up.

*Shortcut.* ``whole_tokens`` proves, once, which strings of the vocabulary the library encodes as one token. A pre-token
that is one of them counts one. Only the rest is merged, each distinct one once per batch; the library does it.

A null text is the empty one, which has no tokens. Null doc_ids and repeated rows are counted like others; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import mapped, offsets, text_slices, whole_texts
from tillworks.llm.word_ids import Remembered

LIMIT = 4096
MARK = "▁"

_RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def separable(pieces: list[str]) -> bool:
    """Whether no piece has the mark of a space behind any other character."""
    return not any(MARK in piece.lstrip(MARK) for piece in pieces)


def pieces_of(model: sentencepiece.SentencePieceProcessor) -> list[str]:
    """The pieces that can come out of merges: no bytes, control or unknown ones."""
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]


@lru_cache(maxsize=2)
def loaded(path: str) -> sentencepiece.SentencePieceProcessor:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if not separable(pieces_of(model)):
        raise ValueError(f"{path} has pieces that reach across spaces")
    if model.encode("a  b ", out_type=str) == model.encode("a b", out_type=str):
        raise ValueError(f"{path} drops spaces")
    return model


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> frozenset[str]:
    """Words (without their first mark) that the library encodes as one token when they stand after one space."""
    model = loaded(path)
    words = [piece[1:] for piece in pieces_of(model) if piece.startswith(MARK) and not piece.startswith(MARK * 2)]
    words = [w for w in words if w]
    return frozenset(w for w, ids in zip(words, model.encode(words, num_threads=1)) if len(ids) == 1)


class Counter:
    def __init__(self, path: str):
        self.model, self.whole, self.memory = loaded(path), whole_tokens(path), Remembered()

    def words(self, words: list[str]) -> np.ndarray:
        """Token counts of words that stand after one space and hold none."""
        counts = [1 if w in self.whole else self.memory.find(w) for w in words]
        rest = [i for i, n in enumerate(counts) if n is None]
        for i, ids in zip(rest, self.model.encode([words[i] for i in rest], num_threads=1)):
            counts[i] = len(ids)
            self.memory.put(words[i], counts[i])
        return np.array(counts, dtype=np.int64)

    def any_text(self, text: str) -> int:
        """Token count of a text with runs of spaces or marks of its own: pre-token by pre-token."""
        if not text:
            return 0
        tokens = _RUNS.findall(MARK + text.replace(" ", MARK))
        plain = [t[1:] for t in tokens if t[1:2] != MARK and len(t) > 1]
        # the library adds a mark of its own, which stands for the first of the run
        runs = [t[1:].replace(MARK, " ") for t in tokens if t[1:2] == MARK or len(t) == 1]
        return int(self.words(plain).sum()) + sum(len(self._run(r)) for r in runs)

    def _run(self, text: str) -> list[int]:
        # a lone mark: the library gives nothing for an empty text, the mark itself is one token
        return self.model.encode(text, num_threads=1) if text else [0]

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Token counts of whole texts."""
        odd = pc.match_substring_regex(texts, f"  |{MARK}|^ | $").to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        counts = self.words(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sums = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.asarray(split.offsets) - split.offsets[0].as_py()
        found = sums[bounds[1:]] - sums[bounds[:-1]]
        found[np.asarray(pc.binary_length(texts)) == 0] = 0
        for i in np.flatnonzero(odd).tolist():
            found[i] = self.any_text(texts[i].as_py())
        return found


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text")
                sizes = np.diff(offsets(texts))
                columns = [part.column("doc_id"), pa.array(sizes), pa.array(counter.texts(texts))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit; ``path``: a sentencepiece model file."""
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    counted = mapped(texts, _counts(path), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
