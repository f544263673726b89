"""Which 64-bit hashes occur in two or more rows: a bit map of fixed size.

Tasks gather their distinct hashes, marked when two of their rows have them,
and send them shortened (12 bits of bucket, 32 bits of rest) to their bucket.
A bucket sets a bit for every hash that two tasks or two rows have. The map
tells no hash that is shared to be alone; it may tell a few others to be
shared, which the exact steps after it sort out. Its size is a parameter, and
so is a bound on what the driver and every task hold. On a corpus so large
that most of its bits are set it lets more through; results stay the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from ebbflow.llm.common import discard, record, release, stage

BUCKET_BITS, REST_BITS = 12, 32
FLUSH = 3_000_000
READS = 16  # jobs that bring the map to the driver, each a part of it
_PARTS = pa.schema([("bucket", pa.int32()), ("alone", pa.binary()), ("shared", pa.binary())])


class SharedFilter:
    """``hits`` tells which hashes may occur in two or more rows, ``often`` which may in many."""

    def __init__(self, bits: np.ndarray, log_bits: int, many: np.ndarray | None = None):
        self.bits, self.many, self.shift = bits, many, np.uint64(64 - log_bits)

    def _in(self, bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        return self._in(self.bits, hashes)

    def often(self, hashes: np.ndarray) -> np.ndarray:
        return self._in(self.many, hashes)


def _parts(hashes: list[np.ndarray]) -> pa.RecordBatch:
    """``hashes``: each row's distinct hashes, one after the other."""
    short = np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS - REST_BITS) if hashes else np.zeros(0, np.uint64)
    values, n = np.unique(short, return_counts=True)
    bounds = np.searchsorted(values, np.arange((1 << BUCKET_BITS) + 1, dtype=np.uint64) << np.uint64(REST_BITS))
    rest, shared = values.astype(np.uint32), n > 1
    buckets = np.flatnonzero(np.diff(bounds))
    cut = [(rest[bounds[b]:bounds[b + 1]], shared[bounds[b]:bounds[b + 1]]) for b in buckets]
    return record(_PARTS, bucket=buckets, alone=[r[~s].tobytes() for r, s in cut], shared=[r[s].tobytes() for r, s in cut])


def shared_filter(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]], log_bits: int = 27,
                  many_parts: int = 0) -> SharedFilter:
    """``hashes_of`` yields arrays of hashes, each row's without repeats, for a batch of ``rows``.

    With ``many_parts``, a second map marks hashes that so many parts of tasks' rows hold. It depends on how
    rows are dealt, so it may serve an order of work, not a result.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        held, size = [], 0
        for b in batches:
            for h in hashes_of(b):
                held.append(h)
                size += len(h)
                if size >= FLUSH:
                    yield _parts(held)
                    held, size = [], 0
        yield _parts(held)

    slice_bits = log_bits - BUCKET_BITS

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        shared = np.concatenate([np.frombuffer(x, np.uint32) for x in parts["shared"]])
        every = np.sort(np.concatenate([*(np.frombuffer(x, np.uint32) for x in parts["alone"]), shared]))  # a part has each once
        again = every[1:][every[1:] == every[:-1]]

        def packed(found):
            bits = np.zeros(1 << slice_bits, bool)
            bits[found >> np.uint32(REST_BITS - slice_bits)] = True
            return np.packbits(bits, bitorder="little").tobytes()

        k = many_parts - 1
        many = every[k:][every[k:] == every[:len(every) - k]] if many_parts else every[:0]
        return pd.DataFrame({"bucket": parts["bucket"][:1], "bits": [packed(np.concatenate([shared, again]))],
                             "many": [packed(many) if many_parts else b""]})

    parts = rows.mapInArrow(run, "bucket int, alone binary, shared binary")
    bits = np.zeros((1 << BUCKET_BITS, (1 << slice_bits) // 8), np.uint8)
    many = np.zeros_like(bits) if many_parts else None
    maps = stage(parts.groupBy("bucket").applyInPandas(merge, "bucket int, bits binary, many binary"), "shared-filter")
    del parts  # else its shuffle files serve on
    for r in maps.coalesce(READS).toLocalIterator():  # a job a partition, as few on a large corpus
        bits[r.bucket] = np.frombuffer(r.bits, np.uint8)
        if many_parts:
            many[r.bucket] = np.frombuffer(r.many, np.uint8)
    discard(maps)
    release(rows.sparkSession)
    return SharedFilter(bits.reshape(-1), log_bits, None if many is None else many.reshape(-1))
