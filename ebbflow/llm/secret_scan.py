"""Secret scan by inferred grammars (operator 11).

Three plain patterns find credentials of known form (``base_spans``). They are
also the labels: a pattern's matches are credentials of its kind, and all other
long runs of credential characters are ``plain``.

Training. Of each kind, the ``most_labelled`` distinct strings of smallest hash
are taken, from all documents: tasks keep their smallest, and the smallest of
those are the same whatever the partitions. One task a kind builds the prefix
tree of its strings and merges states (``infer``): states in order of their
first string, each merged with the first earlier one whose chances to end and
to go on with each character, and those of the states they lead to, differ by
less than the Hoeffding bound at ``alpha``; else it stays. What is left is a
probabilistic automaton of the kind's format. A character's chance in a state
is smoothed by that of its class (digits, letters by case and by being
hexadecimal, signs).

Scan. Every run of credential characters of ``least_length`` or more that no
base span touches is scored by all automata, end included. It is reported
when the likeliest credential automaton gives it ``10 ** least_odds`` times the
likelihood of the plain one, as ``like_<kind>``. Base spans always stay.

Results by case: null and empty texts have no spans; rows that repeat an id,
and null ids, are documents of their own; texts of any length are scanned whole. If no
base pattern matches anywhere, or no other run exists, nothing is added. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import id_and_text, prepare, record, stage


def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


#: Kinds of the plain patterns, in their order. Letters of the key words count in either case, of ASCII only.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(f"""({_either_case("password|passwd|secret|token|api_?key")})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # the pattern with one or more, of 20 characters or more: runs are maximal
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = r"[A-Za-z0-9+/_.=-]{%d,}"
PLAIN = "plain"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, credential)`` in order of start, then kind; places are code points."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), 0, m.group(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), m.end(), 1, m.group()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2, m.group()) for m in _HEX.finditer(text)]
    return [(s, e, KINDS[k], c) for s, e, k, c in sorted(out)]


def other_runs(text: str, base: list[tuple], pattern: re.Pattern) -> list[tuple[int, int, str]]:
    """Runs of credential characters that no base span touches."""
    runs = [(m.start(), m.end(), m.group()) for m in pattern.finditer(text)]
    if not base or not runs:
        return runs
    return [r for r in runs if not any(r[0] < e and s < r[1] for s, e, _, _ in base)]


# ------------------------------------------------------------------ grammar inference
_CLASSES = ["0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", *"+/_.=-"]
_CLASS_OF = {c: k for k, cs in enumerate(_CLASSES) for c in cs}
_ALPHABET = sorted(_CLASS_OF)


class State:
    __slots__ = ("n", "ends", "to", "count")

    def __init__(self):
        self.n, self.ends = 0, 0
        self.to: dict[str, State] = {}
        self.count: dict[str, int] = {}


def prefix_tree(strings: list[str]) -> State:
    root = State()
    for s in strings:
        state = root
        state.n += 1
        for c in s:
            state.count[c] = state.count.get(c, 0) + 1
            state = state.to.setdefault(c, State())
            state.n += 1
        state.ends += 1
    return root


def _alike(f: int, n: int, g: int, m: int, width: float) -> bool:
    return abs(f / n - g / m) < width * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def compatible(a: State, b: State, width: float) -> bool:
    """Whether ending and going on are alike in both states and in those that the same characters lead to."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if not _alike(a.ends, a.n, b.ends, b.n, width):
            return False
        for c in a.count.keys() | b.count.keys():
            if not _alike(a.count.get(c, 0), a.n, b.count.get(c, 0), b.n, width):
                return False
        todo += [(a.to[c], b.to[c]) for c in a.to.keys() & b.to.keys()]
    return True


def fold(into: State, other: State) -> None:
    """Add the tree below ``other`` to ``into``."""
    todo = [(into, other)]
    while todo:
        x, y = todo.pop()
        x.n += y.n
        x.ends += y.ends
        for c, n in y.count.items():
            x.count[c] = x.count.get(c, 0) + n
            if c in x.to:
                todo.append((x.to[c], y.to[c]))
            else:
                x.to[c] = y.to[c]


def infer(strings: list[str], alpha: float = 0.05) -> list[State]:
    """States of the automaton of the strings, the first one to start in."""
    width = math.sqrt(0.5 * math.log(2 / alpha))
    root = prefix_tree(sorted(strings))
    kept = [root]
    seen = {id(root)}
    while True:
        # The open state of most strings: the best known one is decided first.
        border = [(-s.to[c].n, k, c) for k, s in enumerate(kept) for c in s.to if id(s.to[c]) not in seen]
        if not border:
            return kept
        _, k, c = min(border)
        state = kept[k].to[c]
        for red in kept:
            if compatible(red, state, width):
                kept[k].to[c] = red
                fold(red, state)
                break
        else:
            kept.append(state)
            seen.add(id(state))


class Automaton:
    """Log10 likelihoods of strings, by tables over states and ASCII characters."""

    def __init__(self, states: list[State], smooth: float = 1.0):
        n = len(states)
        number = {id(s): k for k, s in enumerate(states)}
        self.to = np.zeros((n, 128), np.int32)
        self.log = np.full((n, 128), -99.0)
        self.end = np.zeros(n)
        for k, s in enumerate(states):
            in_class = np.zeros(len(_CLASSES))
            for c, m in s.count.items():
                in_class[_CLASS_OF[c]] += m
            going = s.n - s.ends
            share = (in_class + smooth / len(_CLASSES)) / (going + smooth)
            common = max(s.to, key=lambda c: (s.count[c], c), default=None)
            for c in _ALPHABET:
                backed = share[_CLASS_OF[c]] / len(_CLASSES[_CLASS_OF[c]])
                # The class holds as much weight as a few observed characters of each of its members.
                weight = smooth * len(_ALPHABET)
                p = (s.count.get(c, 0) + weight * backed) / (going + weight)
                self.log[k, ord(c)] = math.log10(p * (going + smooth) / (s.n + 2 * smooth))
                if c in s.to:
                    self.to[k, ord(c)] = number[id(s.to[c])]
                else:  # a character not seen here leads where one of its class does, else the most common one
                    like = [d for d in s.to if _CLASS_OF[d] == _CLASS_OF[c]]
                    d = max(like, key=lambda d: (s.count[d], d), default=common)
                    self.to[k, ord(c)] = number[id(s.to[d])] if d is not None else k
            self.end[k] = math.log10((s.ends + smooth) / (s.n + 2 * smooth))

    def dump(self) -> str:
        return json.dumps([self.to[:, [ord(c) for c in _ALPHABET]].tolist(), self.log[:, [ord(c) for c in _ALPHABET]].tolist(), self.end.tolist()])

    @classmethod
    def load(cls, text: str) -> Automaton:
        to, log, end = json.loads(text)
        made = cls.__new__(cls)
        made.to, made.log, made.end = np.zeros((len(end), 128), np.int32), np.full((len(end), 128), -99.0), np.array(end)
        at = [ord(c) for c in _ALPHABET]
        made.to[:, at], made.log[:, at] = to, log
        return made

    def score(self, strings: list[str]) -> np.ndarray:
        """All strings step by step together, the longest first so that those still going on come first."""
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        order = np.argsort(-lengths, kind="stable")
        ordered = lengths[order]
        text = np.frombuffer("".join(strings).encode("ascii"), np.uint8)
        begins = (np.cumsum(lengths) - lengths)[order]
        state, total = np.zeros(len(strings), np.int64), np.zeros(len(strings))
        for i in range(int(ordered[0]) if len(ordered) else 0):
            live = np.searchsorted(-ordered, -i, "left")
            c = text[begins[:live] + i]
            total[:live] += self.log[state[:live], c]
            state[:live] = self.to[state[:live], c]
        total += self.end[state]
        out = np.zeros(len(strings))
        out[order] = total
        return out


# ------------------------------------------------------------------ over documents
_LABELLED = pa.schema([("kind", pa.string()), ("hash", pa.int64()), ("value", pa.string())])


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big", signed=True)


def labelled(source: DataFrame, most: int, least_length: int) -> DataFrame:
    """``(kind, hash, value)``: of each kind the ``most`` distinct strings of smallest hash."""
    pattern = re.compile(_RUN % least_length)

    def smallest(found: dict[str, int]) -> dict[str, int]:
        return dict(heapq.nsmallest(most, found.items(), key=lambda x: (x[1], x[0])))

    def run(batches):
        held: dict[str, dict[str, int]] = {k: {} for k in (*KINDS, PLAIN)}
        for b in batches:
            for text in b.column("text").to_pylist():
                base = base_spans(text)
                for _, _, kind, value in base:
                    if value not in held[kind]:
                        held[kind][value] = _hash(value)
                for _, _, value in other_runs(text, base, pattern):
                    if value not in held[PLAIN]:
                        held[PLAIN][value] = _hash(value)
            for kind, found in held.items():
                if len(found) > 4 * most:
                    held[kind] = smallest(found)
        for kind, found in held.items():
            found = smallest(found)
            yield record(_LABELLED, kind=[kind] * len(found), hash=list(found.values()), value=list(found))

    every = stage(source.select("text").mapInArrow(run, "kind string, hash long, value string").distinct(), "secrets-labelled")
    parts = [every.where(F.col("kind") == k).orderBy("hash", "value").limit(most) for k in (*KINDS, PLAIN)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def train(source: DataFrame, most: int, least_length: int, alpha: float) -> dict[str, Automaton]:
    """An automaton for each kind that has strings."""
    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"kind": rows["kind"][:1], "automaton": [Automaton(infer(rows["value"].tolist(), alpha)).dump()]})

    made = labelled(source, most, least_length).groupBy("kind").applyInPandas(learn, "kind string, automaton string")
    return {r.kind: Automaton.load(r.automaton) for r in made.collect()}


_SPANS = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("log10_odds", pa.float64())])))])
_SPANS_DDL = "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean, log10_odds: double>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_labelled: int = 1000,
                 least_length: int = 16, least_odds: float = 4.0, alpha: float = 0.05) -> DataFrame:
    """``(doc_id, spans)`` per row, spans by start, then base kinds as listed, then others; places are code points."""
    prepare(docs.sparkSession)
    source = id_and_text(docs, id_col, text_col)
    automata = train(source, most_labelled, least_length, alpha)
    plain = automata.pop(PLAIN, None)
    if plain is None:
        automata = {}
    shared = docs.sparkSession.sparkContext.broadcast((plain, automata))
    pattern = re.compile(_RUN % least_length)

    def run(batches):
        plain, automata = shared.value
        kinds = [k for k in KINDS if k in automata]
        for b in batches:
            texts = b.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            runs = [other_runs(t, s, pattern) for t, s in zip(texts, base, strict=True)] if kinds else [[] for _ in texts]
            distinct = sorted({r[2] for rs in runs for r in rs})
            odds: dict[str, tuple[float, str]] = {}
            if distinct:
                each = np.stack([automata[k].score(distinct) for k in kinds])
                gain = each.max(0) - plain.score(distinct)
                odds = {s: (float(g), kinds[k]) for s, g, k in zip(distinct, gain, each.argmax(0), strict=True) if g >= least_odds}
            spans = []
            for known, others in zip(base, runs, strict=True):
                own = [(s, KINDS.index(k), k, e, True, None) for s, e, k, _ in known]
                own += [(s, len(KINDS), "like_" + odds[v][1], e, False, odds[v][0]) for s, e, v in others if v in odds]
                spans.append([{"kind": k, "start": s, "end": e, "base": is_base, "log10_odds": g} for s, _, k, e, is_base, g in sorted(own, key=lambda x: x[:2])])
            yield record(_SPANS, doc_id=b.column("doc_id"), spans=spans)

    return source.mapInArrow(run, _SPANS_DDL)


def summary(found: DataFrame) -> DataFrame:
    """Counts and digests of what ``scan_secrets`` returns."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *[of(k) for k in KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
