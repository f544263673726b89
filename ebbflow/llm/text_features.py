"""Statistics of a text that do not depend on its words' meaning."""

from __future__ import annotations

import operator

import numpy as np

CLASSES = ["upper", "lower", "digit", "space", "newline", "stop", "comma", "bang", "bar", "symbol", "bracket", "quote", "control", "high"]
_CLASS = np.full(256, CLASSES.index("symbol"), np.uint8)
for _name, _chars in (("upper", range(0x41, 0x5B)), ("lower", range(0x61, 0x7B)), ("digit", range(0x30, 0x3A)),
                      ("control", [*range(0x20), 0x7F]), ("space", b" \t"), ("newline", b"\n\r"), ("stop", b".?:;"),
                      ("comma", b","), ("bang", b"!"), ("bar", b"|"), ("bracket", b"()[]{}<>"), ("quote", b"'\"-"), ("high", range(0x80, 0x100))):
    _CLASS[list(_chars)] = CLASSES.index(_name)
NAMES = ["log_bytes", "log_words", "word_bytes", "distinct_words", "repeated_neighbours", "distinct_lines", "line_words",
         *(f"share_{c}" for c in CLASSES)]


def statistics(text: bytes) -> list[float]:
    """One number per name in ``NAMES``; all are finite for any text, the empty one included."""
    n, words = len(text), text.split()
    lines = [x for x in text.split(b"\n") if x]
    k = len(words)
    shares = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=len(CLASSES)) / max(n, 1)
    return [np.log1p(n), np.log1p(k), n / max(k, 1) if k else 0.0, len(set(words)) / max(k, 1) ** 0.8,
            sum(map(operator.eq, words, words[1:])) / max(k, 1), len(set(lines)) / max(len(lines), 1),
            np.log1p(k / max(len(lines), 1)), *np.sqrt(shares)]
