"""SentencePiece encoding and decoding by a streaming Viterbi search.

The best segmentation of a text is the path of pieces with the largest sum of scores. The search reads one character
after the other. It keeps, for the places at which a piece can still begin (a walk in the trie of pieces has
begun there), the best path to the place: no further back than the longest piece. When all of
these paths run through one place, what lies before it cannot change any more: its ids are committed and forgotten.
``feed`` and ``finish`` take a text in parts of any length and give the same ids as for the whole.

The vocabulary holds ranks, not probabilities; a piece's score is the negative logarithm of its rank (Zipf's law), in
whole millionths, so equal paths are equal wherever the search began. Of paths with equal scores the one whose last piece is longer is taken. Characters without a piece, and those that
would read as the mark of a space, become their UTF-8 bytes, so decoding gives back every text exactly.

In a table, texts are cut where all paths meet anyway: in front of the mark of a space, or of a run of them, as no piece
has a mark behind other characters. Each distinct stretch (a run of marks and what follows) of a batch is searched once.
Stretches no longer than the longest piece, the window, are searched together: a place after the other for all of
equal length, walks being rows of arrays, and committed at their end. Longer ones go through the streaming search, which
looks for the meeting place of all paths once per longest piece; so a text without spaces holds the paths of what lies
behind that place. Only in repeats such as a run of one letter do paths not meet, and those of the whole run are held. A
null text is the empty one, which has no ids; repeated rows have equal ids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tillworks.llm.common import mapped, text_slices, whole_texts
from tillworks.llm.token_counts import MARK, loaded
from tillworks.llm.word_ids import Remembered

_END = ""  # in a trie node: (id, score) of the piece that ends there
_LETTERS = 0x110000  # code points; the number itself stands for a letter that begins and continues no piece
_STRETCHES = re.compile(" +[^ ]+| +$")
_NEVER = -(1 << 60)  # less than any score
_TOGETHER = 1 << 15  # stretches of equal length that are searched at once


def _score(rank: int) -> int:
    """Whole millionths, so that sums are exact and equal wherever a search begins."""
    return -round(1e6 * log(rank + 1))


class Pieces:
    """The trie of a model's pieces, the ids of its bytes, and what each id decodes to."""

    def __init__(self, path: str):
        model = loaded(path)
        self.root: dict = {}
        self.byte_ids, self.bytes = [0] * 256, [b""] * model.get_piece_size()
        self.longest, rank = 1, 0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i)):
                rank += 1
                self.bytes[i] = piece.replace(MARK, " ").encode()
                self.longest = max(self.longest, len(piece))
                node = self.root
                for letter in piece:
                    node = node.setdefault(letter, {})
                node[_END] = (i, _score(rank))
        self.byte_score = 2 * _score(rank)
        self._lay_out()

    def _lay_out(self) -> None:
        """The trie as arrays: children by (node, letter), the root's by letter alone, and each node's piece."""
        nodes, keys, children = [self.root], [], []
        for number, node in enumerate(nodes):
            for letter, child in node.items():
                if letter != _END:
                    keys.append(number << 21 | ord(letter))
                    children.append(len(nodes))
                    nodes.append(child)
        order = np.argsort(np.array(keys))
        self.keys, self.children = np.array(keys)[order], np.array(children)[order]
        self.first = np.zeros(_LETTERS + 1, dtype=np.int64)  # 0, the root, is nobody's child
        of_root = self.keys < 1 << 21
        self.first[self.keys[of_root]] = self.children[of_root]
        ends = [node.get(_END, (-1, _NEVER)) for node in nodes]
        self.piece, self.score = np.array([e[0] for e in ends]), np.array([e[1] for e in ends])

    def child(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The child of each node by a letter, 0 if there is none."""
        keys = nodes << 21 | letters
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.children[at], 0)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class StreamingEncoder:
    """Ids of one text that comes in parts. Spaces of the text become marks, and one mark stands before it."""

    def __init__(self, table: Pieces):
        self.table = table
        self.scores: dict[int, int] = {0: 0}  # best score up to a place
        self.steps: dict[int, tuple[int, list[int]]] = {}  # place -> (place before, ids in between)
        self.walks: list[tuple[int, dict]] = [(0, table.root)]  # places where a piece has begun, and where it is
        self.at = self.committed = 0
        self.begun = False

    def feed(self, part: str) -> list[int]:
        """Ids that are certain after this part."""
        done: list[int] = []
        if part and not self.begun:
            self.begun = True
            self._read(MARK, True)
        for letter in part:
            self._read(MARK if letter == " " else letter, letter == " " or letter != MARK)
            done.extend(self._certain())
        return done

    def finish(self) -> list[int]:
        return self._path(self.at) if self.begun else []

    def _read(self, letter: str, known: bool) -> None:
        self.at += 1
        at, best, step = self.at, None, None
        walks = []
        for start, node in self.walks:
            child = node.get(letter) if known else None
            if child is None:
                continue
            walks.append((start, child))
            if _END in child:
                piece, score = child[_END]
                score += self.scores[start]
                if best is None or score > best:  # walks come with the earliest start first: the longest piece wins ties
                    best, step = score, (start, [piece])
        if best is None:
            spelled = [self.table.byte_ids[b] for b in letter.encode()]
            best, step = self.scores[at - 1] + self.table.byte_score * len(spelled), (at - 1, spelled)
        self.scores[at], self.steps[at] = best, step
        walks.append((at, self.table.root))
        self.walks = walks

    def _certain(self) -> list[int]:
        """Commits up to the place that the paths to all places still in use share."""
        if self.at - self.committed > 8 * self.table.longest or len(self.walks) < 2:
            return self.commit(self.meeting())
        if len(self.walks) == 2 and self.walks[0][0] == self.at - 1:
            return self.commit(self.at - 1)  # only the last letter may still begin a piece
        return []

    def commit(self, shared: int) -> list[int]:
        """Ids up to a place that all paths share."""
        if shared <= self.committed:
            return []
        ids = self._path(shared)
        self.committed = shared
        first = min(shared, self.walks[0][0])
        self.scores = {p: s for p, s in self.scores.items() if p >= first}
        self.steps = {p: s for p, s in self.steps.items() if p > shared}
        return ids

    def meeting(self) -> int:
        """The last place on the paths to all places at which a piece has begun."""
        places = {start for start, _ in self.walks}
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            places.add(max(self.committed, self.steps[last][0]) if last > self.committed else self.committed)
        return places.pop()

    def _path(self, place: int) -> list[int]:
        """Ids from the last committed place to this one."""
        found: list[list[int]] = []
        while place > self.committed:
            place, ids = self.steps[place]
            found.append(ids)
        return [i for ids in reversed(found) for i in ids]


def encode(text: str, table: Pieces) -> list[int]:
    search = StreamingEncoder(table)
    return [*search.feed(text), *search.finish()]


def decode(ids: list[int], table: Pieces) -> str:
    """The text of ids; the mark that stands before every text is taken off again."""
    return b"".join(map(table.bytes.__getitem__, ids)).decode()[1:]


def _searched(table: Pieces, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of stretches of equal length (rows of letters), one stretch after the other, and how many each has.

    From each place on, in order, the walks of all stretches go down the trie together; a place that no piece reaches
    is reached from the one before by the letter's bytes.
    """
    n, width = letters.shape
    score = np.full((n, width + 1), _NEVER)
    score[:, 0] = 0
    step, piece = np.zeros((n, width + 1), dtype=np.int64), np.full((n, width + 1), -1, dtype=np.int64)
    spelled = 1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF)  # UTF-8 bytes
    spelled[letters == _LETTERS] = len(MARK.encode())
    for at in range(width + 1):
        if at:
            none = np.flatnonzero(score[:, at] == _NEVER)
            score[none, at] = score[none, at - 1] + table.byte_score * spelled[none, at - 1]
            step[none, at] = at - 1
        rows = nodes = None
        for end in range(at + 1, width + 1):
            if rows is None:
                nodes = table.first[letters[:, at]]
                rows = np.flatnonzero(nodes)
                nodes = nodes[rows]
            else:
                nodes = table.child(nodes, letters[rows, end - 1])
                rows, nodes = rows[nodes > 0], nodes[nodes > 0]
            if not len(rows):
                break
            reached = table.score[nodes] + score[rows, at]
            better = (table.piece[nodes] >= 0) & (reached > score[rows, end])  # at equal scores the earlier start, so the longer piece, stays
            to = rows[better]
            score[to, end], step[to, end], piece[to, end] = reached[better], at, table.piece[nodes[better]]
    on_path = np.zeros((n, width + 1), dtype=bool)
    rows, place = np.arange(n), np.full(n, width)
    while len(rows):
        on_path[rows, place] = True
        place = step[rows, place]
        rows, place = rows[place > 0], place[place > 0]
    on_path[:, 0] = False
    row, end = np.nonzero(on_path)
    found = piece[row, end]
    counts = np.where(found < 0, spelled[row, end - 1], 1)
    every = np.repeat(found, counts)
    starts = np.cumsum(counts) - counts
    for i in np.flatnonzero(found < 0).tolist():
        letter = letters[row[i], end[i] - 1]
        for k, b in enumerate((MARK if letter == _LETTERS else chr(letter)).encode()):
            every[starts[i] + k] = table.byte_ids[b]
    return every, np.bincount(row, weights=counts, minlength=n).astype(np.int64)


class Encoder:
    """Ids of many texts. A stretch is what stands between two single spaces; in a run, the further spaces begin it."""

    def __init__(self, path: str):
        self.table, self.memory = pieces(path), Remembered()

    def _long(self, stretch: str) -> np.ndarray:
        """Ids of a stretch that is longer than the longest piece, by the streaming search."""
        found = self.memory.find(stretch)
        if found is None:
            search, window = StreamingEncoder(self.table), self.table.longest
            search.begun = True
            search._read(MARK, True)
            done, due = [], window
            for at in range(0, len(stretch), window):
                if search.at - search.committed > due:
                    done.append(np.array(search.commit(search.meeting()), dtype=np.uint32))
                    due = 2 * due if search.at - search.committed > due else window  # paths may not meet for long
                for letter in stretch[at : at + window]:
                    search._read(MARK if letter == " " else letter, letter == " " or letter != MARK)
            done.append(np.array(search.finish(), dtype=np.uint32))
            found = np.concatenate(done)
            self.memory.put(stretch, found)
        return found

    def distinct(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the stretches, one stretch after the other, and how many each has. The empty one is a lone mark."""
        sizes = np.fromiter(map(len, stretches), dtype=np.int64, count=len(stretches))
        points = np.frombuffer("".join(stretches).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        points = np.where(points == ord(MARK), _LETTERS, np.where(points == ord(" "), ord(MARK), points))
        starts = np.cumsum(sizes) - sizes
        counts, parts = np.zeros(len(stretches), dtype=np.int64), []
        for size in np.unique(sizes[sizes < self.table.longest]).tolist():
            same = np.flatnonzero(sizes == size)
            for first in range(0, len(same), _TOGETHER):
                group = same[first : first + _TOGETHER]
                letters = np.full((len(group), size + 1), ord(MARK), dtype=np.int64)
                letters[:, 1:] = points[starts[group][:, None] + np.arange(size)]
                ids, counts[group] = _searched(self.table, letters)
                parts.append((group, ids))
        for i in np.flatnonzero(sizes >= self.table.longest).tolist():
            ids = self._long(stretches[i])
            counts[i] = len(ids)
            parts.append((np.array([i]), ids))
        begins = np.cumsum(counts) - counts
        every = np.empty(counts.sum(), dtype=np.uint32)
        for group, ids in parts:
            n = counts[group]
            every[np.repeat(begins[group] - np.cumsum(n) + n, n) + np.arange(len(ids))] = ids
        return every, counts

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        odd = np.flatnonzero(pc.match_substring_regex(texts, "  |^ | $").to_numpy(zero_copy_only=False))
        split = pc.split_pattern(texts, " ")
        words, sizes = split.flatten(), np.diff(np.asarray(split.offsets))
        sizes[np.asarray(pc.binary_length(texts)) == 0] = -1  # no stretch at all, though the split gives an empty one
        if len(odd):  # runs of spaces: cut in front of each run
            plain = np.ones(len(texts), dtype=bool)
            plain[odd] = False
            found = [[x[1:] for x in _STRETCHES.findall(" " + t)] for t in texts.take(pa.array(odd)).to_pylist()]
            words = pa.concat_arrays([words.filter(pa.array(np.repeat(plain, np.abs(sizes)))), pa.array([w for f in found for w in f], pa.string())])
            order = np.concatenate([np.flatnonzero(plain), odd])
            sizes = np.concatenate([sizes[plain], [len(f) for f in found]])
        else:
            order = np.arange(len(texts))
        coded = words.dictionary_encode()
        every, counts = self.distinct(coded.dictionary.to_pylist())
        begins, at = np.cumsum(counts) - counts, coded.indices.to_numpy()
        n = counts[at]
        ends = np.cumsum(n)
        ids = every[np.repeat(begins[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])
        stops = np.cumsum(np.abs(sizes))
        spans = [None] * len(texts)
        for i, a, b, size in zip(order.tolist(), ends[stops - np.abs(sizes)].tolist(), ends[stops].tolist(), sizes.tolist()):
            spans[i] = (a, b if size > 0 else a)
        for a, b in spans:
            yield ids[a:b]


_NAMES = ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip"]


def _coded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for part in text_slices(batch):
                rows = []
                for text, ids in zip(part.column("text").to_pylist(), encoder.encode(part.column("text"))):
                    back = decode(ids.tolist(), encoder.table)
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((len(ids), crc, hashlib.sha256(back.encode()).hexdigest(), back == text))
                columns = [pa.array(c) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=_NAMES)

    return run


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for part in text_slices(batch):
                ids = pa.array([x.astype(np.int32) for x in encoder.encode(part.column("text"))], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every text."""
    texts = whole_texts(docs)
    return mapped(texts, _ids(path), f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of ``encoded``; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([decode(ids or [], pieces(path)) for ids in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "text"])

    return mapped(coded.select("doc_id", "ids"), run, f"doc_id {coded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers), decoded_sha256 and round_trip."""
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean"
    return mapped(texts, _coded(path), schema)
