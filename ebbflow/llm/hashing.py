"""Words ``[^\\x20\\x09-\\x0D]+`` of texts as 64-bit hashes, in bulk.

A word's hash is a polynomial of its bytes modulo 2**64, mixed at the end. It
does not depend on the word's place. All words of many texts come from one
running sum over their bytes, with no Python per word.

Two different words among n distinct ones share a hash with a chance of about
n**2 / 2**65; the operators treat equal hashes as equal words.
"""

from __future__ import annotations

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHUNK = 1 << 20  # bytes hashed at a time
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    for name, base in (("up", _P), ("down", _P_INVERSE)):
        if len(_POWERS[name]) <= n:
            steps = np.full(max(n, CHUNK) + 1, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def _hash_chunk(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a chunk and where they start."""
    white = WHITE[a]
    edges = np.flatnonzero(np.diff(white, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(a))
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((LOWER[a].astype(np.uint64) + np.uint64(1)) * up[:len(a)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), starts


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the number of words of each text."""
    joined = b" ".join(texts)
    a = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    hashes, starts, at = [], [], 0
    while at < len(a):
        end = min(at + CHUNK, len(a))
        while end < len(a) and not (rest := np.flatnonzero(WHITE[a[end:end + CHUNK]])).size:
            end = min(end + CHUNK, len(a))
        if end < len(a):
            end += int(rest[0])  # a chunk ends before white space
        h, s = _hash_chunk(a[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    counts = np.diff(np.searchsorted(np.concatenate(starts), begins))
    return np.concatenate(hashes), counts


def text_groups(texts: list[bytes], most: int = CHUNK):
    """Slices of a batch with about ``most`` bytes of text each, to bound memory."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield slice(at, i + 1)
            at, size = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))
