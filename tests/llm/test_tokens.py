"""Token counts, the piece codec, word ids and packing."""

from __future__ import annotations

import random

import brute
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import TEXTS
from tokenizers import Tokenizer

from tillworks.llm import packing, piece_codec, token_counts
from tillworks.llm.word_ids import Remembered, WordIds

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
SIGNS = ["a", "B", "the", "é", "Ö", " ", "  ", "\n", "\t", ".", ",", "'s", "’", "1", "İ", "Σ", "ſ", "ǆ", "́", "​", "ı", "漢", "😀", "▁", "<s>", "<|endoftext|>", "<0x0A>", "\x00"]


def odd_texts(n: int = 1500) -> list[str]:
    random.seed(11)
    return [t or "" for _, t in TEXTS] + ["".join(random.choices(SIGNS, k=random.randint(0, 20))) for _ in range(n)]


def test_word_ids_equal_the_library():
    texts = odd_texts()
    got = [ids[:-1].tolist() for ids in WordIds(WORDS).encode(pa.array(texts), 2)]
    library = Tokenizer.from_file(WORDS)
    assert got == [code.ids for code in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library():
    texts = odd_texts()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert token_counts.Counter(PIECES).texts(pa.array(texts)).tolist() == [len(ids) for ids in model.encode(texts)]


def test_whole_tokens_are_proven():
    whole = token_counts.whole_tokens(PIECES)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert "the" in whole and len(whole) > 5000
    assert all(len(model.encode(w)) == 1 for w in sorted(whole)[::50])
    assert not token_counts.separable(["▁a", "a▁b"])


def test_token_count_query(messy):
    got = sorted(map(tuple, token_counts.token_counts(messy, PIECES).collect()), key=repr)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t in TEXTS]
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(messy.where("false"), PIECES).count() == 0


@pytest.mark.parametrize("signs", ["漢字仮名交じり文", "ABCDEFGHabcdefgh0123456789+/=", "var;function(){}=>a.b", "e"])
def test_long_words_hold_a_window_of_paths(monkeypatch, signs):
    random.seed(12)
    word = "".join(random.choices(signs, k=30_000 if len(signs) > 1 else 2_000))
    held, read = [], piece_codec.StreamingEncoder._read

    def watched(search, letter, known):
        read(search, letter, known)
        held.append(max(len(search.scores), len(search.steps)))

    monkeypatch.setattr(piece_codec.StreamingEncoder, "_read", watched)
    encoder = piece_codec.Encoder(PIECES)
    (got,) = encoder.encode(pa.array([word]))
    assert len(set(signs)) == 1 or max(held) <= 32 * encoder.table.longest  # the paths of a run of one letter do not meet
    assert got.tolist() == piece_codec.encode(word, encoder.table) and piece_codec.decode(got.tolist(), encoder.table) == word


def _whole_viterbi(text: str, table: piece_codec.Pieces) -> list[int]:
    """The whole search at once, all pieces at all places."""
    letters = [(c if c != " " else "▁", c != "▁") for c in " " + text] if text else []
    best, back = [0], [None]
    for end in range(1, len(letters) + 1):
        found = None
        for start in range(max(0, end - table.longest), end):
            node = table.root
            for c, known in letters[start:end]:
                node = node.get(c) if node and known else None
            if node and piece_codec._END in node:
                piece, score = node[piece_codec._END]
                if found is None or best[start] + score > found[0]:
                    found = best[start] + score, start, [piece]
        if found is None:
            spelled = [table.byte_ids[b] for b in letters[end - 1][0].encode()]
            found = best[end - 1] + table.byte_score * len(spelled), end - 1, spelled
        best.append(found[0])
        back.append(found[1:])
    ids, at = [], len(letters)
    while at:
        at, some = back[at]
        ids = some + ids
    return ids


def test_streaming_search_equals_the_whole_one():
    table = piece_codec.pieces(PIECES)
    for text in odd_texts(300):
        text = text[:300]
        want = _whole_viterbi(text, table)
        search, got, at = piece_codec.StreamingEncoder(table), [], 0
        while at < len(text):
            n = random.randint(1, 7)
            got += search.feed(text[at : at + n])
            at += n
        assert got + search.finish() == want
        assert piece_codec.decode(want, table) == text


def test_encoder_equals_the_whole_search():
    table, texts = piece_codec.pieces(PIECES), [t[:200] for t in odd_texts(200)]
    texts += ["", " ", "  ", "a ", "x  ", " a", "▁", "▁▁ ▁", "a.  B  c", "    if x:\n        y = 1  ", "ab" * 40, "ẞ😀\u2581é"]
    got = piece_codec.Encoder(PIECES).encode(pa.array(texts))
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == _whole_viterbi(text, table)
        assert piece_codec.decode(ids.tolist(), table) == text


def test_search_keeps_a_bounded_window():
    table = piece_codec.pieces(PIECES)
    search = piece_codec.StreamingEncoder(table)
    held = 0
    for _ in range(300):
        search.feed("some words without an end ")
        held = max(held, len(search.steps), len(search.scores))
    assert held <= 10 * table.longest


def test_codec_queries(messy):
    rows = piece_codec.round_trips(messy, PIECES).collect()
    assert len(rows) == len(TEXTS) and all(r.round_trip for r in rows)
    back = piece_codec.decoded(piece_codec.encoded(messy, PIECES), PIECES)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((d, t or "") for d, t in TEXTS), key=repr)
    assert piece_codec.round_trips(messy.where("false"), PIECES).count() == 0


def test_packing_of_messy_rows(messy):
    rows = [(d, t) for d, t in TEXTS if d not in (8, None)]
    pieces = packing.packed_documents(messy.where("doc_id <> 8"), WORDS).collect()
    assert brute.check_packing(rows, pieces)["padding"] == 0
    assert packing.packed_documents(messy.where("false"), WORDS).count() == 0
    assert packing.packed_documents(messy, WORDS).where("doc_id IS NULL OR doc_id = 8").count() == 3


def test_packing_of_real_texts(small, small_rows):
    figures = brute.check_packing(small_rows, packing.packed_documents(small, WORDS).collect())
    assert figures["padding"] == 0 and figures["sequences"] <= figures["used"] / 4096 + 8 * 13


@pytest.mark.parametrize("limits", [(64, 3, 64), (64, 100, 20), (100, 2, 30), (8, 1, 1)])
def test_limits_hold_together(limits):
    random.seed(limits[0])
    examples = []
    for n in range(300):
        size = random.choice([1, 2, 5, 40, 200])
        examples.append(packing.Example(n, packing.np.arange(size), quiet=random.randint(0, size)))
    quiet = {e.name: e.quiet for e in examples}
    sizes = {e.name: len(e.ids) for e in examples}
    sequences, covered = {}, {}
    for example, start, n, sequence, offset in packing.pack(iter(examples), limits, pool=20):
        sequences.setdefault(sequence, []).append((offset, n, max(0, start + n - max(start, quiet[example.name]))))
        covered.setdefault(example.name, []).append((start, n))
    for name, size in sizes.items():
        at = 0
        for start, n in sorted(covered[name]):
            assert start == at
            at += n
        assert at == size
    for found in sequences.values():
        assert sum(n for _, n, _ in found) <= limits[0] and len(found) <= limits[1] and sum(x for _, _, x in found) <= limits[2]


def test_memory_of_words_is_bounded():
    memory = Remembered(10)
    for n in range(1000):
        memory.put(str(n), n)
    assert memory.find("999") == 999 and memory.find("5") is None and len(memory.young) + len(memory.old) <= 20
