"""Nearest neighbours by multi-index hashing of learned binary codes (operator 2).

Codes. On a bounded sample of the vectors, several rotations are learned that
bring the centred vectors close to the corners of a cube (iterative
quantisation, each from its own random start). The signs of all rotated
coordinates are a vector's code.

Index. Every valid vector is indexed, in blocks of bounded size. A code is
split into 8-bit substrings; for each, a block has its rows in order of the
substring's value and where each value's bucket begins.

Search. If two codes differ in at most r bits and there are m substrings, one
substring differs in at most r // m bits; more exactly, one of the first
r % m + 1 does, or one of the others differs in at most r // m - 1. Probing the
buckets within these distances finds every code within the radius: the rows of
those buckets are gathered, no others are looked at, and the answer tells how
many a query probed. Found codes are compared in full, and those within the radius are reranked by their cosine
on the original vectors in double precision.

The radius is calibrated on the sample: it holds ``coverage`` of the true
neighbours of sample queries. Larger tables only have nearer neighbours. A
query that finds fewer rows than it should return is searched again with the
largest radius, which is every code. The set of queries meets all rows in
blocks, (query block, index block) by (query block, index block).

Results by case: vectors that are null, zero, of another length than most or
hold null or non-finite components take no part. A row is no candidate for a
query of its own id. Equal scores rank the smaller id first. Rows with null
ids take no part. Repeated rows are candidates each; repeated queries are
answered each. With fewer than ``k`` candidates all are returned. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import prepare, record, stage

_VALUES = np.arange(256, dtype=np.uint8)
_MASKS = [_VALUES[np.bitwise_count(_VALUES) <= near] for near in range(9)]  # what turns a substring into those near it


@dataclass
class Codes:
    """What the sample taught: the mean, the rotations side by side, the radius."""

    mean: np.ndarray
    rotations: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.rotations.shape[1]

    def encode(self, unit: np.ndarray) -> np.ndarray:
        """A row of substrings, one byte each, per vector."""
        return np.packbits((unit - self.mean) @ self.rotations > 0, axis=1)


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn_codes(sample: np.ndarray, rotations: int = 4, turns: int = 25, queries: int = 300, k: int = 5,
                coverage: float = 0.985, seed: int = 3) -> Codes:
    """Rotations by iterative quantisation, and the radius that covers the sample's neighbours."""
    unit = unit_rows(sample)
    d, mean = unit.shape[1], unit.mean(0)
    centred, rng, found = unit - mean, np.random.default_rng(seed), []
    while sum(r.shape[1] for r in found) % 8 or len(found) < rotations:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(turns):
            u, _s, v = np.linalg.svd(np.where(centred @ r > 0, 1.0, -1.0).T @ centred, full_matrices=False)
            r = (u @ v).T
        found.append(r)
    codes = Codes(mean, np.concatenate(found, axis=1), 0)
    codes.radius = codes.bits
    if len(unit) > 8 * k:
        code = codes.encode(unit)
        at = rng.choice(len(unit), min(queries, len(unit)), replace=False)
        near = unit[at] @ unit.T
        near[np.arange(len(at)), at] = -2
        best = np.argpartition(-near, k, axis=1)[:, :k]
        apart = np.bitwise_count(code[at][:, None, :] ^ code[best]).sum(2)
        codes.radius = int(np.quantile(apart, coverage, method="higher"))
    return codes


class BlockIndex:
    """The multi-index of one block of codes: rows in buckets by the value of each substring."""

    def __init__(self, code: np.ndarray):
        self.rows = len(code)
        self.order = [np.argsort(column, kind="stable") for column in code.T]
        self.begin = [np.searchsorted(column[order], np.arange(257)) for column, order in zip(code.T, self.order, strict=True)]
        self.wide = np.ascontiguousarray(np.pad(code, ((0, 0), (0, -code.shape[1] % 8)))).view(np.uint64)

    def bucket_rows(self, j: int, values: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of the buckets of substring ``j`` within ``near`` bits of each query's value."""
        probes = (values[:, None] ^ _MASKS[near]).astype(np.int64)
        first, size = self.begin[j][probes].ravel(), (self.begin[j][probes + 1] - self.begin[j][probes])
        query = np.repeat(np.arange(len(values)), size.sum(1))
        size = size.ravel()
        place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return query, self.order[j][place]

    def within(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (query, row) pairs whose codes differ in at most ``radius`` bits, and how many rows each query probed."""
        m = len(self.order)
        most, odd = divmod(radius, m)
        probed = np.zeros((len(query), self.rows), bool)
        for j in range(m):
            near = min(most if j <= odd else most - 1, 8)
            if near >= 0:
                probed[self.bucket_rows(j, query[:, j], near)] = True
        q, row = np.nonzero(probed)
        wide = np.ascontiguousarray(np.pad(query, ((0, 0), (0, -query.shape[1] % 8)))).view(np.uint64)
        keep = np.zeros(len(q), bool)
        for s in range(0, len(q), 1 << 18):
            e = slice(s, s + (1 << 18))
            keep[e] = np.bitwise_count(wide[q[e]] ^ self.wide[row[e]]).sum(1, dtype=np.int64) <= radius
        return q[keep], row[keep], np.bincount(q, minlength=len(query))


def best_of_block(index: BlockIndex, ids, unit, q_ids, q_code, q_unit, radius: int, k: int):
    """Each query's ``k`` nearest rows of the block, (query, row, score), and how many rows each query probed."""
    out, probed = [], np.zeros(len(q_ids), np.int64)
    for s in range(0, len(q_ids), 256):
        q, row, probed[s:s + 256] = index.within(q_code[s:s + 256], radius)
        q += s
        own = q_ids[q] == ids[row]
        q, row = q[~own], row[~own]
        if not len(q):
            continue
        score = np.empty(len(q))
        for a in range(0, len(q), 1 << 16):
            e = slice(a, a + (1 << 16))
            score[e] = (q_unit[q[e]] * unit[row[e]]).sum(1)
        order = np.lexsort((ids[row], -score, q))
        q, row, score = q[order], row[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        out.append((q[place < k], row[place < k], score[place < k]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0), probed
    return *(np.concatenate(x) for x in zip(*out, strict=True)), probed


_BLOCKS = pa.schema([("ids", pa.binary()), ("vectors", pa.binary())])


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("vector")
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vector"))
            .where(F.col("id").isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0)
                   & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))))


def index_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """``(slot, ids, vectors)``: blocks of at most ``block_rows`` rows; slots number about as many as blocks."""
    def pack(batches):
        for b in batches:
            for s in range(0, b.num_rows, block_rows):
                part = b.slice(s, block_rows)
                yield record(_BLOCKS, ids=[part.column("id").to_numpy().tobytes()],
                             vectors=[part.column("vector").flatten().to_numpy().tobytes()])

    return stage(rows.mapInArrow(pack, "ids binary, vectors binary"), "multi-index")


def search_blocks(blocks: DataFrame, queries: DataFrame, codes: Codes, radius: int, k: int, query_rows: int) -> DataFrame:
    """``(row, query_id, vec_id, score, probed)``: each query's ``k`` nearest of every block, and a row without
    ``vec_id`` that tells how many of the slot's rows it probed."""
    slots, chunks = max(1, blocks.count()), max(1, -(-queries.count() // query_rows))

    def numbered(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = blocks.withColumn("slot", (F.abs(F.xxhash64("ids")) % slots).cast("int")).withColumn("chunk", numbered(chunks))
    right = queries.withColumn("chunk", (F.abs(F.xxhash64("row")) % chunks).cast("int")).withColumn("slot", numbered(slots))

    def search(rows: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": [], "probed": []})]
        if len(rows) and len(asking):
            probed = np.zeros(len(asking), np.int64)
            q_row, q_id, q_unit = asking["row"].to_numpy(), asking["id"].to_numpy(), unit_rows(np.stack(asking["vector"]))
            q_code = codes.encode(q_unit)
            for ids, vectors in zip(rows["ids"], rows["vectors"], strict=True):
                ids = np.frombuffer(ids, np.int64)
                unit = unit_rows(np.frombuffer(vectors).reshape(len(ids), -1))
                q, at, score, own = best_of_block(BlockIndex(codes.encode(unit)), ids, unit, q_id, q_code, q_unit, radius, k)
                probed += own
                found.append(pd.DataFrame({"row": q_row[q], "query_id": q_id[q], "vec_id": ids[at], "score": score, "probed": 0}))
            found.append(pd.DataFrame({"row": q_row, "query_id": q_id, "vec_id": pd.array([None] * len(q_id), "Int64"), "score": -2.0,
                                       "probed": probed}))
        return pd.concat([f.astype({"vec_id": "Int64"}) for f in found])

    return left.groupBy("slot", "chunk").cogroup(right.groupBy("slot", "chunk")).applyInPandas(
        search, "row long, query_id long, vec_id long, score double, probed long")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, sample_rows: int = 20_000, block_rows: int = 4096,
            query_rows: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding", **learning) -> DataFrame:
    """``(query_id, rank, vec_id, score, probed)``; ``is_query`` is a condition on the column ``id``.

    The codes are learned from at most ``sample_rows`` rows, those whose ids hash lowest.
    """
    spark = vectors.sparkSession
    prepare(spark)
    valid = _valid(vectors, id_col, vec_col)
    sample = valid.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").toArrow()["vector"].to_pylist()
    sizes, counts = np.unique([len(x) for x in sample], return_counts=True)
    d = int(sizes[counts.argmax()]) if sample else 1
    known = np.array([x for x in sample if len(x) == d]).reshape(-1, d)
    codes = learn_codes(known, k=k, **learning) if len(known) else Codes(np.zeros(1), np.eye(1, 8), 8)
    rows = valid.where(F.size("vector") == d)
    blocks = index_blocks(rows, block_rows)
    queries = stage(rows.where(is_query).withColumn("row", F.monotonically_increasing_id()), "multi-index-queries")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")

    def answers(asking: DataFrame, radius: int) -> DataFrame:
        found = search_blocks(blocks, asking, codes, radius, k, query_rows)
        found = found.withColumns({"rank": F.row_number().over(best), "probed": F.sum("probed").over(Window.partitionBy("row"))})
        return stage(found.where((F.col("rank") <= k) & F.col("vec_id").isNotNull()), "multi-index-found")

    found = answers(queries, codes.radius)
    enough = found.where(F.col("rank") == min(k, max(rows.count() - 1, 1))).select("row")
    short = stage(queries.join(enough, "row", "left_anti"), "multi-index-short")
    if not short.isEmpty():  # the largest radius holds every code
        found = found.join(short.select("row"), "row", "left_anti").unionByName(answers(short, codes.bits))
    return found.select("query_id", "rank", "vec_id", "score", "probed")
