"""Parquet sinks.

All writes are single jobs: one ``partitionBy`` write covers every routed
table instead of one statement per (tenant, rule), and the input is computed
once.

File layout vs. skew: rows are rebalanced on the output partition's columns
(a ``REBALANCE`` hint), which Spark sizes at run time from what the shuffle
holds: small output partitions share a task, each in one file; one that is
larger than the advisory partition size is split over several tasks and
files, so a hot (table, date) does not land in one task.

A clustered table is range-partitioned on (partition column, cluster columns)
instead, so the files of one partition hold ranges that do not overlap and
min/max statistics prune on the cluster key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_TARGET_ROWS_PER_FILE = 2_000_000


def _write(out: DataFrame, path: str, partition_cols: list[str], mode: str, target_rows_per_file: int) -> None:
    (out.write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd")
     .option("maxRecordsPerFile", int(target_rows_per_file))
     .partitionBy(*partition_cols)
     .parquet(path))


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite",
                      target_rows_per_file: int = DEFAULT_TARGET_ROWS_PER_FILE,
                      num_partitions: int | None = None) -> None:
    """zstd Parquet, hive-partitioned; ``overwrite`` replaces only the partitions
    present in ``df`` (dynamic partition overwrite), others are kept."""
    keys = [F.col(f"`{c}`") for c in partition_cols]
    out = df.hint("rebalance", *([num_partitions] if num_partitions else []), *keys)
    _write(out, path, partition_cols, mode, target_rows_per_file)


def write_routed(routed: DataFrame, path: str, layout: str = "partitioned", **kw) -> None:
    """Routed events.

    ``layout="partitioned"``: one table, ``<path>/table_name=<tenant>_<suffix>/date=<d>/``.
    ``layout="table_folders"``: one folder per routed table,
    ``<path>/<tenant>_<suffix>/date=<d>/``, as the upstream tables are laid out. The
    data is still written by one job (into a staging folder under ``path``);
    the written (table, date) partitions are then moved into place, replacing
    the same dates of the same tables and leaving every other date alone.
    """
    if layout == "partitioned":
        write_partitioned(routed, path, ["table_name", "date"], **kw)
        return
    if layout != "table_folders":
        raise ValueError("layout must be 'partitioned' or 'table_folders'")
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex[:12]}"
    write_partitioned(routed, staging, ["table_name", "date"], mode="errorifexists", **kw)
    publish_table_folders(routed.sparkSession, staging, path)


def publish_table_folders(spark, staging: str, target: str) -> int:
    """Move ``staging/table_name=<t>/date=<d>`` into ``target/<t>/date=<d>``.

    Driver-side filesystem metadata calls, one per (table, date) partition the
    write produced (bounded by tables x dates of one run), never per row.
    Returns the number of partitions published."""
    from urllib.parse import unquote

    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    moved = 0
    for t in fs.listStatus(Path(staging)):
        name = t.getPath().getName()
        if not t.isDirectory() or not name.startswith("table_name="):
            continue
        table_dir = Path(target, unquote(name[len("table_name="):]))
        fs.mkdirs(table_dir)
        for d in fs.listStatus(t.getPath()):
            if not d.isDirectory() or not d.getPath().getName().startswith("date="):
                continue
            dest = Path(table_dir, d.getPath().getName())
            # The old folder is set aside first and only goes once the new one is in place.
            aside = Path(table_dir, f"_old-{d.getPath().getName()}-{uuid.uuid4().hex[:12]}")
            held = fs.exists(dest) and fs.rename(dest, aside)
            if not fs.rename(d.getPath(), dest):
                if held:
                    fs.rename(aside, dest)
                raise RuntimeError(f"could not move {d.getPath()} to {dest}")
            if held:
                fs.delete(aside, True)
            moved += 1
    fs.delete(Path(staging), True)
    return moved


def write_aggregates(agg_output: DataFrame, path: str, **kw) -> None:
    """Per-tenant ad aggregates as ``table_name=<tenant>_..._preaggregates/date=<d>/``."""
    write_partitioned(agg_output, path, ["table_name", "date"], **kw)


def write_clustered(df: DataFrame, path: str, partition_col: str, cluster_cols: list[str], mode: str = "overwrite",
                    target_rows_per_file: int = DEFAULT_TARGET_ROWS_PER_FILE) -> None:
    """Partitioned by ``partition_col``; each file holds its own range of
    ``cluster_cols``, in order, so min/max statistics prune on them (S15)."""
    order = [F.col(f"`{c}`") for c in (partition_col, *cluster_cols)]
    _write(df.repartitionByRange(*order).sortWithinPartitions(*order), path, [partition_col], mode, target_rows_per_file)


def read_partitioned(spark, path: str, partition_types: dict[str, str] | None = None) -> DataFrame:
    """Read a hive-partitioned table back, casting partition columns as declared
    (partition values are strings on disk)."""
    df = spark.read.option("basePath", path).parquet(path)
    for c, t in (partition_types or {}).items():
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast(t))
    return df
