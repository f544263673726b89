"""Dead-letter quarantine of source files that cannot be read.

Instead of byte-copying each failed object plus a sidecar ``.error.txt``, the
failed files become rows of a Parquet table, one folder per run: where the file came
from, where its DLQ copy belongs, why it failed, when, and (optionally) its
bytes. Failed files are a small subset of the listing; their bytes are read
with one ``binaryFile`` scan over exactly those paths.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.functions import columns as X
from ebbflow.session import ship_package
from ebbflow.sources import blocks
from ebbflow.sources.paths import glob_escape, norm_path

STATUS_OK = "OK"
MAX_CELL = 1 << 30  # bytes of a file that one cell takes


def quarantine_frame(files: DataFrame, clock: C.RunClock, dlq_location: str,
                     layout: str = "flat") -> DataFrame:
    """One row per failed file: source_path, file_name, dlq_path, reason,
    quarantined_at, length."""
    ts = F.lit(clock.as_of).cast("timestamp")
    failed = files.where(F.col("status") != F.lit(STATUS_OK))
    return failed.select(
        F.col("path").alias("source_path"),
        "file_name",
        X.dlq_path(F.lit(dlq_location.rstrip("/")), ts, F.col("file_name"), layout).alias("dlq_path"),
        F.col("status").alias("reason"),
        ts.alias("quarantined_at"),
        "length",
    )


def with_content(spark: SparkSession, quarantined: DataFrame, most_bytes: int = MAX_CELL) -> DataFrame:
    """Attach the raw bytes of each quarantined file (zero-byte files get an
    empty value). Paths come from the quarantine rows themselves. Files longer
    than ``most_bytes`` do not fit a cell and have no content here: ``write_parts``
    keeps them, in parts."""
    fits = quarantined.where((F.col("length") > 0) & (F.col("length") <= most_bytes))
    here = [r["source_path"] for r in fits.select("source_path").collect()]
    empty = F.when(F.col("length") == 0, F.lit(b"").cast("binary"))
    opened = [p for p in here if blocks.is_local(p)]
    others = [p for p in here if not blocks.is_local(p)]
    frames = []
    if opened:  # Spark's binaryFile source leaves out hidden names
        frames.append(blocks.file_parts(fits.where(F.col("source_path").isin(opened)) if others else fits, most_bytes).select("source_path", "content"))
    if others:
        frames.append(spark.read.format("binaryFile").load([glob_escape(p) for p in others])
                      .select(norm_path(F.col("path")).alias("source_path"), "content"))
    if not frames:
        return quarantined.withColumn("content", empty)
    blobs = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return quarantined.join(blobs, "source_path", "left").withColumn("content", F.coalesce(F.col("content"), empty))


def write_parts(spark: SparkSession, quarantined: DataFrame, path: str, run: str, most_bytes: int = MAX_CELL,
                part_bytes: int = 64 << 20) -> int:
    """Keep files that no cell holds as numbered parts, ``(source_path, part, content)``; returns how many files."""
    ship_package(spark)
    long = quarantined.where(F.col("length") > most_bytes).select("source_path", "length")
    paths = [r["source_path"] for r in long.collect()]
    tried: dict[str, bool] = {}
    scheme = F.split("source_path", ":")[0]
    closed = [s for s, p in {p.split(":", 1)[0]: p for p in paths}.items() if not tried.setdefault(s, blocks.reachable(p))]
    if closed:  # tasks cannot open these: the row in the quarantine table tells of them
        long = long.where(~scheme.isin(closed))
    n = sum(p.split(":", 1)[0] not in closed for p in paths)
    if n:
        write_quarantine(blocks.file_parts(long, part_bytes), path, run)
    return n


def run_folder(path: str, run: str) -> str:
    return f"{path}/run={re.sub(r'[^0-9A-Za-z-]+', '-', run)}"


def write_quarantine(df: DataFrame, path: str, run: str) -> None:
    """One folder ``run=<run>`` per run, so a repeated run replaces its own rows."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(run_folder(path, run))
