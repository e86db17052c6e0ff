"""Plain versions of the text operators, one document after the other."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import xxhash


def simhash(text: str, words: int = 3) -> int:
    found = text.encode().lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = [b" ".join(found[i : i + words]) for i in range(len(found) - words + 1)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows: list[tuple[int, str]], bits: int = 2) -> dict[int, tuple[str, int]]:
    marks = {d: simhash(t or "") for d, t in rows}
    distinct = np.array(sorted(set(marks.values())), dtype=np.uint64)
    root = {int(m): int(m) for m in distinct}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    for m in distinct:
        x = distinct ^ m
        n = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        for other in distinct[n <= bits]:
            a, b = find(int(m)), find(int(other))
            root[max(a, b)] = min(a, b)
    first: dict[int, int] = {}
    for d, m in marks.items():
        r = find(m)
        first[r] = min(first.get(r, d), d)
    return {d: (f"{m:016x}", first[find(m)]) for d, m in marks.items()}


def edits(rows: list[tuple[int, str]]) -> dict[int, tuple[int, str]]:
    rows = sorted((d, t or "") for d, t in rows)
    out = {}
    for i, (d, t) in enumerate(rows):
        n = len(t) // 4
        changed = t[: len(t) - n] + rows[(i + 1) % len(rows)][1][:n]
        out[d] = (len(t), hashlib.sha256(changed.encode()).hexdigest())
    return out


def check_packing(rows: list[tuple[int, str]], pieces: list, limit: int = 4096) -> dict:
    """Asserts that every id lies in exactly one piece and that no sequence overlaps; returns figures."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for (d, t), code in zip(rows, tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array([*code.ids, 2], dtype="<u4")
        at = 0
        for p in sorted(by_doc.pop(d), key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : at].tobytes())
        assert at == len(ids)
    assert not by_doc
    padding = used = 0
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limit
        used += at
        padding += 0 if at & (at - 1) == 0 else limit - at
    return {"sequences": len(by_sequence), "used": used, "padding": padding}
