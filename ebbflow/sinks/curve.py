"""Clustering along a space-filling curve (S15 with several cluster columns).

Files sorted by (a, b) have narrow ranges of ``a`` and all of ``b``, so only a
filter on ``a`` skips files. Here each cluster column becomes a rank among
2**bits quantiles of its values, taken from a sample of bounded size, and the
bits of all ranks are interleaved (Z order). Files that hold a range of the
interleaved key have a narrow range of every column, so a filter on any one of
them skips files. The sample decides only how rows are laid out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.names import fresh_names
from ebbflow.sinks.parquet import DEFAULT_TARGET_ROWS_PER_FILE, _write


def quantile_bounds(df: DataFrame, columns: list[str], bits: int, sample_rows: int = 20_000) -> dict[str, list]:
    """Up to 2**bits - 1 bounds of each column, from about ``sample_rows`` rows of smallest row hash."""
    total = df.count()
    if not total:
        return {c: [] for c in columns}
    # A share of the hash space: the same rows whatever the partitions.
    share = min(1.0, sample_rows / total)
    code = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    drawn = df.where(F.pmod(code, F.lit(1 << 20)) < max(1, int(share * (1 << 20)))).select(*[F.col(f"`{c}`") for c in columns]).limit(4 * sample_rows)
    rows = drawn.collect()  # at most four times the sample
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        cuts = {values[len(values) * k >> bits] for k in range(1, 1 << bits)} if values else set()
        out[c] = sorted(cuts)
    return out


def rank(c: Column, bounds: list) -> Column:
    """How many bounds a value has reached; null comes first."""
    if not bounds:
        return F.lit(0).cast("long")
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= c)), F.lit(0)).cast("long")


def z_key(ranks: list[Column], bits: int) -> Column:
    """The ranks' bits interleaved, from the highest on."""
    key = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for r in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long")))
    return key


def write_curve(df: DataFrame, path: str, partition_col: str, cluster_cols: list[str], bits: int = 6, mode: str = "overwrite",
                target_rows_per_file: int = DEFAULT_TARGET_ROWS_PER_FILE, num_partitions: int | None = None) -> None:
    """Partitioned by ``partition_col``; each file holds a range of the curve through ``cluster_cols``."""
    if bits * len(cluster_cols) > 63:
        raise ValueError("bits times the number of columns must be below 64")
    bounds = quantile_bounds(df, cluster_cols, bits)
    (key,) = fresh_names(df.columns, "__z")
    out = df.withColumn(key, z_key([rank(F.col(f"`{c}`"), bounds[c]) for c in cluster_cols], bits))
    order = [F.col(f"`{partition_col}`"), F.col(key), *[F.col(f"`{c}`") for c in cluster_cols]]
    spread = out.repartitionByRange(num_partitions, *order) if num_partitions else out.repartitionByRange(*order)
    _write(spread.sortWithinPartitions(*order).drop(key), path, [partition_col], mode, target_rows_per_file)
