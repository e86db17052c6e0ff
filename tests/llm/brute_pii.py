"""The base spans of personal data, by the standard library's regular expressions."""

from __future__ import annotations

import re

KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base(text: str) -> list[tuple[str, int, int]]:
    found = []
    for n, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            if _passes(kind, m.group()):
                found.append((m.start(), n, m.end()))
    return [(KINDS[n], a, b) for a, n, b in sorted(found)]
