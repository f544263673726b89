"""Periodic runs of words by online dyadic square catching (operator 12).

A run is a stretch of words of smallest period q, at least ``least_length``
words and ``exponent`` times q long, that no neighbouring word extends.

Words are appended to a stream. For each power of two m, every completed block
of m words at a multiple of m has a catcher, which watches for squares of
periods m to 2m - 1 that start in it: the block has to come again q words
further on. So each appended word, which completes the suffix of m words that
ends with it, advances one comparison at each level: that suffix against the
one catcher whose block lies m to 2m - 1 words before it. A block and the next
one that both come again at the same distance are reported as a square; squares
of one period that share q words merge. As a run is four periods long, it
holds two such blocks wherever it lies, so none is missed. Suffixes are
compared by running fingerprints, and every merged square is then compared
word by word and grown to both sides to the words that end its run. A square
inside a run of a lower level is no run of its own (Fine and Wilf), and is
dropped before that.

All documents of a group are one stream, with a word of its own between two of
them, so no run spans documents. A group holds about 1 MB of text or a single
longer document; a document is held whole by one task.

Results by case: null and empty texts, and texts of white space, have no words,
no runs and an empty collapsed text. Rows that repeat an id, and null ids, are
documents of their own. Texts of any length count whole. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import id_and_text, prepare, record, text_bytes
from ebbflow.llm.hashing import _powers, mix, text_groups

APPEND = 1 << 17  # words appended at a time


class SquareCatcher:
    """Runs of a growing sequence of numbers."""

    def __init__(self, least_length: int = 6, exponent: int = 4):
        if exponent < 4:
            raise ValueError("exponent must be 4 or more")  # shorter runs need not hold two blocks that recur
        self.least_length, self.exponent = least_length, exponent
        self.words = np.zeros(0, np.int64)
        self.sums = np.zeros(1, np.uint64)  # of fingerprints, up to each word
        self.next: list[int] = []  # by level: the first suffix not compared yet
        self.tail: list[np.ndarray] = []  # by level: whether the last m suffixes met their block
        self.squares: list[list[np.ndarray]] = []  # by level: (period, begin, end) as rows

    def append(self, words: np.ndarray, longest: int | None = None) -> None:
        """``longest``: no run is longer than this so far, which bounds the levels (all words if not given)."""
        at = len(self.words)
        up, _ = _powers(at + len(words))
        more = np.cumsum(mix(words.astype(np.uint64) + np.uint64(1)) * up[at:at + len(words)]) + self.sums[-1]
        self.words = np.concatenate([self.words, words])
        self.sums = np.concatenate([self.sums, more])
        longest = len(self.words) if longest is None else longest
        while self.exponent << len(self.next) <= longest:
            m = 1 << len(self.next)
            self.next.append(m)
            self.tail.append(np.zeros(m, bool))
            self.squares.append([])
        for level in range(len(self.next)):
            self._advance(level)

    def _advance(self, level: int) -> None:
        m, first = 1 << level, self.next[level]
        end = len(self.words) - m + 1  # suffixes that are complete by now
        if end <= first:
            return
        _, down = _powers(end)
        # From the start of the block before the first suffix's: all catchers that are compared with.
        base = ((first >> level) - 1) << level
        marks = (self.sums[base + m:end + m] - self.sums[base:end]) * down[base:end]
        catchers = np.repeat(marks[::m], m)
        met = marks[first - base:] == catchers[first - base - m:end - base - m]
        both = np.concatenate([self.tail[level], met])
        hit = np.flatnonzero(met & both[:len(met)]) + first
        if len(hit):
            period = m + (hit & (m - 1))
            self.squares[level].append(merged(np.stack([period, hit - period - m, hit + m])))
        self.tail[level] = both[len(both) - m:].copy()
        self.next[level] = end

    def runs(self) -> np.ndarray:
        """``(begin, end, period)`` by row, in order of begin and period."""
        found = np.zeros((0, 3), np.int64)
        for squares in self.squares:
            if not squares:
                continue
            period, begin, end = merged(np.concatenate(squares, axis=1))
            new = ~_inside(found, begin, end)
            grown = [self._grow(*row) for row in zip(period[new].tolist(), begin[new].tolist(), end[new].tolist(), strict=True)]
            own = np.array(sorted({r for rows in grown for r in rows}), np.int64).reshape(-1, 3)
            own = own[own[:, 1] - own[:, 0] >= 4 * own[:, 2]]
            own = own[~_inside(found, own[:, 0], own[:, 1])]
            found = np.concatenate([found, own])
        length = found[:, 1] - found[:, 0]
        found = found[length >= np.maximum(self.least_length, self.exponent * found[:, 2])]
        return found[np.lexsort((found[:, 2], found[:, 0]))]

    def _grow(self, period: int, begin: int, end: int) -> list[tuple[int, int, int]]:
        """The stretches of this period that [begin, end) holds, as long as the words allow; one unless fingerprints lied."""
        w = self.words
        off = np.flatnonzero(w[begin:end - period] != w[begin + period:end])
        cuts = [begin - 1, *(off + begin).tolist(), end - period]
        out = []
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            if y > x + 1 or not len(off):
                lo = x + 1 - (self._same(x, x + period, -1) if x + 1 == begin else 0)
                hi = y + (self._same(y, y + period, 1) if y == end - period else 0)
                out.append((lo, hi + period, period))
        return out

    def _same(self, i: int, j: int, step: int) -> int:
        """How many words from i and from j on, i < j, are the same in the direction of ``step``."""
        w, n, size = self.words, 0, 16
        while True:
            if step > 0:
                x, y = w[i + n:i + n + size], w[j + n:j + n + size]
                x = x[:len(y)]
            else:
                x, y = w[max(i - n - size + 1, 0):max(i - n + 1, 0)][::-1], w[max(j - n - size + 1, 0):max(j - n + 1, 0)][::-1]
                y = y[:len(x)]
            differ = np.flatnonzero(x != y)
            if len(differ):
                return n + int(differ[0])
            n += len(x)
            if len(x) < size:
                return n
            size *= 2


def merged(squares: np.ndarray) -> np.ndarray:
    """Rows (period, begin, end) with those of one period joined that share at least a period of words."""
    period, begin, end = squares[:, np.lexsort((squares[1], squares[0]))]
    reach = end.copy()
    # Squares of one level and period have one length, or come merged and apart, so the one before reaches furthest.
    new = np.append(True, (period[1:] != period[:-1]) | (begin[1:] + period[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin)) - 1
    return np.stack([period[first], begin[first], end[last]])


def _inside(runs: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of [begin, end) lie inside one of the runs."""
    if not len(runs):
        return np.zeros(len(begin), bool)
    order = np.argsort(runs[:, 0], kind="stable")
    reach = np.maximum.accumulate(runs[order, 1])
    at = np.searchsorted(runs[order, 0], begin, "right") - 1
    return (at >= 0) & (reach[at] >= end)


def group_runs(documents: list[list[bytes]], least_length: int, exponent: int) -> list[np.ndarray]:
    """Runs of every document's words, ``(begin, end, period)`` counted from its first word."""
    known: dict[bytes, int] = {}
    numbers = count()
    catcher = SquareCatcher(least_length, exponent)
    begins, longest, at = [], 0, 0
    waiting: list[np.ndarray] = []
    for d, words in enumerate(documents):
        ids = np.fromiter(map(known.setdefault, words, numbers), np.int64, len(words))
        begins.append(at)
        longest = max(longest, len(ids))
        at += len(ids) + 1
        waiting += [ids, np.array([-2 - d])]  # a number of its own after each document
    stream = np.concatenate(waiting) if waiting else np.zeros(0, np.int64)
    for s in range(0, len(stream), APPEND):
        catcher.append(stream[s:s + APPEND], min(longest, s + APPEND))
    runs = catcher.runs()
    cuts = np.searchsorted(runs[:, 0], begins)
    return [r - np.array([b, b, 0]) for r, b in zip(np.split(runs, cuts[1:]), begins, strict=True)] if begins else []


_RUNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("collapsed", pa.binary()),
                   ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))])
_RUNS_DDL = "doc_id long, n_words long, collapsed binary, runs array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, least_length: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, collapsed, runs)`` per row: runs by start and period, and the words left, by one space, when
    each run keeps its first period."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), text_bytes(b.column("text"))
            for part in text_groups(texts):
                documents = [t.split() for t in texts[part]]  # bytes split at \x20 and \x09-\x0D only
                out: dict[str, list] = {f.name: [] for f in _RUNS}
                for i, words, runs in zip(ids[part], documents, group_runs(documents, least_length, exponent), strict=True):
                    if len(runs):
                        keep = np.ones(len(words), bool)
                        for begin, end, period in runs.tolist():
                            keep[begin + period:end] = False
                        left = [words[x] for x in np.flatnonzero(keep).tolist()]
                    else:
                        left = words
                    out["doc_id"].append(i)
                    out["n_words"].append(len(words))
                    out["collapsed"].append(b" ".join(left))
                    out["runs"].append([{"start": x, "length": y - x, "period": p} for x, y, p in runs.tolist()])
                yield record(_RUNS, **out)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, _RUNS_DDL)


def repeated_stretch(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, of every tenth document (by crc32 of its id) with a stretch repeated from some word to its end."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


_TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def with_repeated_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with ``repeated_stretch`` applied; other texts stay as they are."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text")
            made = []
            for i, t in zip(ids, texts.to_pylist(), strict=True):
                if zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0:
                    t = b" ".join(repeated_stretch(t.encode().split(), i)).decode()
                made.append(t)
            yield record(_TEXTS, doc_id=ids, text=made)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, text string")


def summary(found: DataFrame) -> DataFrame:
    """Digests of what ``periodic_runs`` returns, and its longest run (ties: smallest start, then period)."""
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    found = found.withColumn("best", first)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
