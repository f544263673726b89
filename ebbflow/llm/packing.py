"""Hierarchical multi-length packing (operator 1).

Documents become token ids (an end id closes each). Within a task they are
routed to context-size tiers, powers of two up to ``max_tokens``: full long
windows are cut off directly, the rest of a document goes to the shortest tier
that holds it. Tiers are packed from the longest down. The gap that a window
of a tier leaves is filled from the shorter tiers, longest fitting piece
first, and at last by cutting a piece, so every window is full. Every flush of
``buffer_tokens`` packs all tiers like this and keeps what fills no window of its
tier for the next one, so tiers do not change with the size of a task. What
remains at the end of a task is less than one long window; its binary digits
give windows of smaller powers of two, which need no padding either.

Windows of a tier are then dealt into step groups of equal token counts,
balanced by attention cost (the sum of squared piece lengths): within a group
of windows the dearest go round the steps in a snake order.

Tasks pack independently, so there is no shuffle; ``sequence_id`` holds the
partition number above its low 33 bits. Memory per task is bounded by
``buffer_tokens`` ids and the longest document.

Results by case: a null or empty text is one id, the end id. A text of any
length is cut into as many windows as it needs. Repeated rows are packed like
any others. A null id stays null. An empty table gives no rows.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ebbflow.llm.common import id_and_text, prepare, record
from ebbflow.llm.word_tokens import token_ids

SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_id", pa.int64()), ("ids", pa.binary())])
DDL = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
       "tier int, step_id long, ids binary")
MIN_TIER = 256


class Piece:
    """A run of a document's ids: ``data`` are the ids' bytes, four each."""

    __slots__ = ("doc_id", "start", "data", "doc_tokens")

    def __init__(self, doc_id, start: int, data: bytes, doc_tokens: int):
        self.doc_id, self.start, self.data, self.doc_tokens = doc_id, start, data, doc_tokens

    def __len__(self) -> int:
        return len(self.data) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first ``n`` ids, and the rest."""
        return (Piece(self.doc_id, self.start, self.data[: 4 * n], self.doc_tokens),
                Piece(self.doc_id, self.start + n, self.data[4 * n:], self.doc_tokens))


class Packer:
    """The tiers of one task. ``add`` routes a document; ``pack`` yields full windows."""

    def __init__(self, max_tokens: int, min_tier: int = MIN_TIER):
        self.max_tokens = max_tokens
        self.tiers = [t for t in (1 << k for k in range(max_tokens.bit_length())) if min(min_tier, max_tokens) <= t <= max_tokens]
        self.pools: dict[int, list[Piece]] = {t: [] for t in self.tiers}  # each by length
        self.pending = 0

    def route(self, piece: Piece) -> None:
        bisect.insort(self.pools[next(t for t in self.tiers if len(piece) <= t)], piece, key=len)
        self.pending += len(piece)

    def add(self, piece: Piece) -> list[list[Piece]]:
        """Windows that the document fills by itself; the rest is routed."""
        full = []
        while len(piece) >= self.max_tokens:
            window, piece = piece.cut(self.max_tokens)
            full.append([window])
        if len(piece):
            self.route(piece)
        return full

    def _take(self, gap: int) -> Piece:
        """The longest piece that fits a gap, or else part of a piece."""
        for tier in reversed(self.tiers):
            if at := bisect.bisect_right(self.pools[tier], gap, key=len):
                piece = self.pools[tier].pop(at - 1)
                break
        else:
            piece = next(self.pools[t] for t in self.tiers if self.pools[t]).pop()
        self.pending -= len(piece)
        if len(piece) > gap:
            piece, rest = piece.cut(gap)
            self.route(rest)
        return piece

    def _fill(self, size: int, first: Piece | None = None) -> list[Piece]:
        window, room = ([first], size - len(first)) if first else ([], size)
        while room:
            piece = self._take(room)
            window.append(piece)
            room -= len(piece)
        return window

    def pack(self, last: bool = False) -> list[list[Piece]]:
        """Full windows, longest tiers first; with ``last`` all that is left."""
        windows = []
        for tier in reversed(self.tiers):
            pool = self.pools[tier]
            while pool and self.pending >= tier:
                first = pool.pop()
                self.pending -= len(first)
                if len(first) > tier:
                    first, rest = first.cut(tier)
                    self.route(rest)
                windows.append(self._fill(tier, first))
                pool = self.pools[tier]
        if not last:
            return windows
        for k in reversed(range(self.max_tokens.bit_length())):
            if self.pending >= 1 << k:
                windows.append(self._fill(1 << k))
        return windows


def step_groups(windows: list[tuple[int, int]], step_tokens: int, first_step: int) -> tuple[list[int], int]:
    """Step numbers of windows given as (size, cost), and the next free number.

    Each step of a tier has at most ``step_tokens`` tokens, all of one size. The
    windows are dealt by falling cost, back and forth over the steps.
    """
    steps = [0] * len(windows)
    for size in sorted({s for s, _ in windows}, reverse=True):
        of = sorted((i for i, w in enumerate(windows) if w[0] == size), key=lambda i: -windows[i][1])
        n = -(-len(of) // max(1, step_tokens // size))
        for k, i in enumerate(of):
            lap, at = divmod(k, n)
            steps[i] = first_step + (at if lap % 2 == 0 else n - 1 - at)
        first_step += n
    return steps, first_step


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, max_tokens: int = 2048,
                   step_tokens: int = 32768, buffer_tokens: int = 2_000_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its ids (little-endian, 32 bits each): the sequences are the pieces of a
    ``sequence_id`` by ``offset``. ``tier`` is a sequence's size, ``step_id`` its step group."""
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    prepare(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def run(batches):
        base = TaskContext.get().partitionId() << 33
        ids, packer = token_ids(tokenizer_path), Packer(max_tokens)
        made = {"sequences": 0, "steps": 0}

        def rows(windows):
            costs = [(sum(map(len, w)), sum(len(p) ** 2 for p in w)) for w in windows]
            steps, made["steps"] = step_groups(costs, step_tokens, made["steps"])
            out: dict[str, list] = {f.name: [] for f in SCHEMA}
            for window, (size, _), step in zip(windows, costs, steps, strict=True):
                offset = 0
                for p in window:
                    for name, value in (("doc_id", p.doc_id), ("start", p.start), ("length", len(p)),
                                        ("doc_tokens", p.doc_tokens), ("sequence_id", base + made["sequences"]),
                                        ("offset", offset), ("tier", size), ("step_id", base + step), ("ids", p.data)):
                        out[name].append(value)
                    offset += len(p)
                made["sequences"] += 1
            return record(SCHEMA, **out)

        windows, held = [], 0
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                data = ids.id_bytes(text) + end
                new = packer.add(Piece(doc_id, 0, data, len(data) // 4))
                windows += new
                held += len(new) * max_tokens
                if packer.pending + held >= buffer_tokens:
                    yield rows(windows + packer.pack())
                    windows, held = [], 0
        windows += packer.pack(last=True)
        if windows:
            yield rows(windows)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, DDL)
