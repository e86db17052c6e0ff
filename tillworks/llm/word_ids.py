"""Ids of whole texts, word by word, as the tokenizers library gives them.

White space separates pre-tokens and is then dropped by the word tokenizer, so the ids of a text are those of its
white-space words, one after the other (``_checked`` makes sure of the file's settings). Each distinct word of a batch is
encoded once. Words of Latin letters, with or without a full stop or comma behind them, are merged here, all of
the batch at a time; other words go to the library, and what it gives is remembered. The memory is bounded: of
two generations the older one is let go.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tillworks.llm.common import data_bytes, offsets

REMEMBERED = 200_000

# Letters below U+0250 whose lower case is one letter, and the two signs that often follow a word.
_LATIN = "[A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]"
_PLAIN = f"^{_LATIN}+[.,]?$"
_END_OF_WORD = "</w>"
_NEVER = np.iinfo(np.int32).max
_SIZES = [0, 4, 6, 8, 10, 12, 16, 24, 40, 64]


class Remembered:
    """A bounded word -> value memory of two generations."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.young, self.old = most, {}, {}

    def find(self, word: str):
        value = self.young.get(word)
        if value is None and (value := self.old.get(word)) is not None:
            self.put(word, value)
        return value

    def put(self, word: str, value) -> None:
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[word] = value


def _checked(told: dict) -> dict:
    """The file's model, if it drops white space before it looks at words and has no token with any."""
    steps = [step["type"] for step in told["normalizer"]["normalizers"]]
    split = told["pre_tokenizer"]["pretokenizers"][0]
    drops = split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed"
    bare = not any(c.isspace() for token in told["added_tokens"] for c in token["content"])
    plain = told["model"]["type"] == "BPE" and told["model"]["end_of_word_suffix"] == _END_OF_WORD
    if not (drops and bare and plain and steps == ["NFC", "Replace", "Lowercase"]):
        raise ValueError("this tokenizer does not treat white-space words one by one")
    return told["model"]


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class Merges:
    """Byte-pair merges of many words at a time: in each round every word merges its first pair of the lowest rank."""

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        letters = byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocabulary[c + _END_OF_WORD] for c in letters], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or _NEVER. Ids below zero stand for nothing."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (right >= 0), self.ranks[at], _NEVER)

    def merged(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (one row per word, -1 behind them) and their number; words are ranges of bytes of equal class of size."""
        width = int(sizes.max())
        place = np.arange(width)
        inside = place < sizes[:, None]
        symbols = self.inner[data[np.where(inside, starts[:, None] + place, 0)]]
        symbols[~inside] = -1
        rows = np.arange(len(sizes))
        symbols[rows, sizes - 1] = self.last[data[starts + sizes - 1]]
        if width == 1:
            return symbols, sizes.copy()
        ids, counts = symbols.copy(), sizes.copy()
        ranks = self._rank(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            first = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(rows)), first]
            going = lowest < _NEVER
            done = ~going
            ids[rows[done]] = symbols[done]
            rows, symbols, ranks, first, lowest = rows[going], symbols[going], ranks[going], first[going], lowest[going]
            if not len(rows):
                break
            counts[rows] -= 1
            n = np.arange(len(rows))
            shift = np.minimum(place + (place > first[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, shift, axis=1)
            symbols[:, -1] = -1
            symbols[n, first] = self.made[lowest]
            between = place[:-1]
            ranks = np.take_along_axis(ranks, np.minimum(between + (between >= first[:, None]), width - 2), axis=1)
            ranks[:, -1] = _NEVER
            here = np.minimum(first, width - 2)
            ranks[n, here] = self._rank(symbols[n, here], symbols[n, here + 1])
            before = np.maximum(first - 1, 0)
            ranks[n, before] = self._rank(symbols[n, before], symbols[n, before + 1])
        return ids, counts


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Tokenizer, Merges]:
    with open(path, encoding="utf-8") as file:
        model = _checked(json.load(file))
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, Merges(model)


class WordIds:
    def __init__(self, path: str):
        self.tokenizer, self.merges = _loaded(path)
        self.memory = Remembered()
        self.signs = {c: self._library([c])[0] for c in ".,"}

    def _library(self, words: list[str]) -> list[np.ndarray]:
        codes = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(code.ids, dtype=np.uint32) for code in codes]

    def _others(self, words: list[str]) -> list[np.ndarray]:
        found = [self.memory.find(w) for w in words]
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self._library([words[i] for i in new])):
            found[i] = ids
            self.memory.put(words[i], ids)
        return found

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, one word after the other, and how many each has."""
        plain = pc.match_substring_regex(words, _PLAIN).to_numpy(zero_copy_only=False).astype(bool)
        small = pc.utf8_lower(words)
        at, data = offsets(small), data_bytes(small)
        at = at - at[0]
        starts, sizes = at[:-1], np.diff(at)
        ends = data[np.maximum(at[1:] - 1, 0)] if len(data) else np.zeros(len(sizes), dtype=np.uint8)
        sign = plain & ((ends == ord(".")) | (ends == ord(",")))
        letters = sizes - sign
        counts = np.zeros(len(words), dtype=np.int64)
        parts = []  # (word numbers, ids by row, their number)
        for least, most in zip(_SIZES, _SIZES[1:]):  # words of about the same size at a time
            group = np.flatnonzero(plain & (letters > least) & (letters <= most))
            if len(group):
                ids, n = self.merges.merged(data, starts[group], letters[group])
                counts[group] = n
                parts.append((group, ids, n))
        other = np.flatnonzero(counts == 0)
        found = self._others(words.take(pa.array(other)).to_pylist())
        counts[other] = [len(ids) for ids in found]
        sign[other] = False
        counts[sign] += np.array([len(self.signs[chr(e)]) for e in ends[sign].tolist()], dtype=np.int64)
        begins = np.concatenate([[0], np.cumsum(counts)])
        every = np.empty(begins[-1], dtype=np.uint32)
        for group, ids, n in parts:
            inside = np.arange(ids.shape[1]) < n[:, None]
            every[(begins[group][:, None] + np.arange(ids.shape[1]))[inside]] = ids[inside]
        for i, ids in zip(other.tolist(), found):
            every[begins[i] : begins[i + 1]] = ids
        for c, ids in self.signs.items():
            group = np.flatnonzero(sign & (ends == ord(c)))
            for k, one in enumerate(ids):
                every[begins[group + 1] - len(ids) + k] = one
        return every, counts

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """Ids of each text, and the end mark."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        every, counts = self.distinct(coded.dictionary)
        begins = np.cumsum(counts) - counts
        at = coded.indices.to_numpy()
        n = counts[at]
        ends = np.cumsum(n)
        ids = every[np.repeat(begins[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])
        bounds = ends[np.asarray(split.offsets) - split.offsets[0].as_py()].tolist()
        for a, b in zip(bounds, bounds[1:]):
            whole = np.empty(b - a + 1, dtype=np.uint32)
            whole[:-1] = ids[a:b]
            whole[-1] = end_id
            yield whole
