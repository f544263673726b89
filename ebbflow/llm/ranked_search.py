"""Ranked lexical search, term at a time with limited accumulators (operator 13).

Every item is a query over all documents. Two passes over the documents:

1. Tasks count, for the items' terms, how many of their documents hold each,
   and all documents' terms; sums of these give every term's weight and the
   average length. They are counts of the whole table.
2. Tasks index blocks of documents by term and answer every item on a block.
   Terms come rarest first. A term adds its exact integer contribution to the
   accumulators of its documents and opens new ones, until the largest
   contributions that the remaining terms can make on this block together stay
   below the k-th best score, partial ones of the block and final ones of
   earlier blocks of the task alike. From then on no document without an
   accumulator can reach the best k, so only those that have one and can still
   reach it are looked up in the remaining terms' lists. Each task hands out
   the best k of its documents, and their best k by item are the result.

Items go to tasks in parts of about ``chunk_pairs`` (item, term) pairs, chosen
by a hash of the item, so what is broadcast has that size whatever the number
of items; each part takes the two passes. A task holds one block of about
``block_bytes`` of text, and k rows for each item of the part.

Results by case: a null or empty text, and one without terms, has none and is
no document for any count; an item without terms has no rows. Rows that repeat
an item id are one item with the terms of all of them; a null item id is an
item. Each row of the documents counts for itself, also when ids repeat (such
rows are found next to each other); a null doc_id comes after all others of its
score. Texts of any length count whole. Extra columns are ignored; an empty
table on either side gives no rows.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import id_and_text, prepare, record, stage, text_bytes

NULL_ID = (1 << 63) - 1
# Bytes that no term holds become spaces, and A-Z becomes a-z.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII, lower-cased in A-Z."""
    return text.translate(_TERM_BYTES).split()


class Block:
    """Inverted lists of a block of documents over the known terms."""

    def __init__(self, ids: np.ndarray, sizes: list[int], of: np.ndarray, term: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int):
        """``of`` and ``term``: document place and known term of each occurrence; ``weight`` by term."""
        self.ids = ids
        key, tf = np.unique(term * len(ids) + of, return_counts=True)
        term, self.docs = np.divmod(key, max(len(ids), 1))
        m = np.array([100 - 90 + (90 * n * n_docs) // n_terms for n in sizes], np.int64)
        tf = tf.astype(np.int64)
        self.score = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs]))
        self.bounds = np.searchsorted(term, np.arange(len(weight) + 1))
        self.most = np.zeros(len(weight), np.int64)
        held = np.flatnonzero(np.diff(self.bounds))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.score, self.bounds[held])

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.bounds[t], self.bounds[t + 1])
        return self.docs[at], self.score[at]

    def best(self, query: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of documents that may be among the best k, all of those that are included.

        ``query``: terms, rarest first; ``floor``: the k-th best score so far. Also returns how many accumulators were opened.
        """
        rest = np.append(np.cumsum(self.most[query][::-1])[::-1], 0)
        if rest[0] < max(floor, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        sums = np.zeros(len(self.ids), np.int64)
        at, bar = 0, max(floor, 1)
        while at < len(query) and rest[at] >= bar:
            docs, score = self.postings(query[at])
            at += 1
            if len(docs):
                sums[docs] += score
                bar = max(bar, kth(sums[sums > 0], k))
        live = np.flatnonzero(sums)
        opened = len(live)
        for i in range(at, len(query)):
            live = live[sums[live] + rest[i] >= bar]
            docs, score = self.postings(query[i])
            if len(docs) and len(live):
                found = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
                hit = docs[found] == live
                sums[live[hit]] += score[found[hit]]
                bar = max(bar, kth(sums[live], k))
        live = live[sums[live] >= bar]
        return live, sums[live], opened


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest score, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def keep_best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by ascending id."""
    at = np.lexsort((ids, -scores))[:k]
    return ids[at], scores[at]


_COUNTS = pa.schema([("term", pa.int64()), ("n", pa.int64())])
_N_DOCS, _N_TERMS = -1, -2


def _term_counts(source: DataFrame, known) -> dict[int, int]:
    """Documents that hold each known term, all documents with terms, and all their terms."""
    def run(batches):
        df = np.zeros(len(known.value), np.int64)
        n_docs = n_terms = 0
        for b in batches:
            for text in text_bytes(b.column("text")):
                words = terms(text)
                n_docs += bool(words)
                n_terms += len(words)
                at = [known.value[w] for w in known.value.keys() & set(words)] if words else []
                df[at] += 1
        held = np.flatnonzero(df)
        yield record(_COUNTS, term=np.append(held, [_N_DOCS, _N_TERMS]), n=np.append(df[held], [n_docs, n_terms]))

    counts = source.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in counts.collect()}


_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _answer(source: DataFrame, known, queries, weight, n_docs: int, n_terms: int, k: int, block_bytes: int) -> DataFrame:
    """``(item, doc_id, score)``: the best k of each task's documents for each item."""
    def run(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries.value]
        held: list[tuple[int, int, np.ndarray]] = []
        size = 0

        def solve():
            of = np.repeat(np.arange(len(held)), [len(t) for _, _, t in held])
            block = Block(np.array([i for i, _, _ in held], np.int64), [n for _, n, _ in held], of,
                          np.concatenate([t for _, _, t in held]), weight.value, n_docs, n_terms)
            for q, query in enumerate(queries.value):
                ids, scores = best[q]
                at, found, _ = block.best(query, k, kth(scores, k))
                if len(at):
                    best[q] = keep_best(np.append(ids, block.ids[at]), np.append(scores, found), k)

        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), text_bytes(b.column("text")), strict=True):
                words = terms(text)
                if not words:
                    continue
                t = np.fromiter(map(known.value.get, words, repeat(-1)), np.int64, len(words))
                held.append((NULL_ID if i is None else i, len(words), t[t >= 0]))
                size += len(text) + 100
                if size >= block_bytes:
                    solve()
                    held, size = [], 0
        if held:
            solve()
        yield record(_FOUND, item=np.repeat(np.arange(len(best)), [len(s) for _, s in best]),
                     doc_id=np.concatenate([i for i, _ in best] or [np.zeros(0, np.int64)]),
                     score=np.concatenate([s for _, s in best] or [np.zeros(0, np.int64)]))

    return source.mapInArrow(run, "item long, doc_id long, score long")


_PAIRS = pa.schema([("item_id", pa.int64()), ("term", pa.binary())])


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct ``(item_id, term)``."""
    def run(batches):
        for b in batches:
            pairs = [(i, t) for i, text in zip(b.column("item_id").to_pylist(), text_bytes(b.column("text")), strict=True)
                     for t in set(terms(text))]
            yield record(_PAIRS, item_id=[i for i, _ in pairs], term=[t for _, t in pairs])

    source = items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return stage(source.mapInArrow(run, "item_id long, term binary").distinct(), "ranked-items")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", chunk_pairs: int = 500_000, block_bytes: int = 8 << 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    prepare(spark)
    source = id_and_text(docs, id_col, text_col)
    pairs = item_terms(items, item_col, item_text_col)
    parts = max(1, -(-pairs.count() // chunk_pairs))
    results = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    sc = spark.sparkContext
    for part in range(parts):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        by_item: dict[int | None, list[bytes]] = {}
        for item, term in own.collect():  # about chunk_pairs rows
            by_item.setdefault(item, []).append(bytes(term))
        names = sorted({t for ts in by_item.values() for t in ts})
        known = {t: i for i, t in enumerate(names)}
        known_b = sc.broadcast(known)
        counts = _term_counts(source, known_b)
        n_docs, n_terms = counts.get(_N_DOCS, 0), counts.get(_N_TERMS, 0)
        df = np.array([counts.get(t, 0) for t in range(len(names))], np.int64)
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        # Rarest first; terms that no document holds add nothing.
        queries = []
        for ts in by_item.values():
            at = np.array(sorted((known[t] for t in ts), key=lambda t: (df[t], t)), np.int64)
            queries.append(at[df[at] > 0])
        found = _answer(source, known_b, sc.broadcast(queries), sc.broadcast(weight), n_docs, n_terms, k, block_bytes)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id"))
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        item_ids = spark.createDataFrame(list(enumerate(by_item)), "item long, item_id long")
        found = found.join(F.broadcast(item_ids), "item").select(  # at most one row for each of the part's pairs
            "item_id", "rank", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "score")
        results = results.unionByName(found) if parts > 1 else found
    return results
