"""Compaction of small files.

Micro-batches and routed writes leave many small files in a partition. Files
are listed, packed into bins of about ``target_bytes`` within their partition
(in order of size, a new bin whenever the running total passes another
multiple of the target), and every bin of two files or more is rewritten as one
file by one task, so tasks have about the same work whatever the partitions'
sizes. Each partition is then swapped on its own: its new files come in place
before the old ones go, and a marker names both until then, so a run that was
cut short is completed by the next one (``finish_swaps``). Files that need no
company are left alone, and a second run finds nothing to do.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbflow.session import scratch_path
from ebbflow.sources import listing
from ebbflow.sources.paths import glob_escape, plain_path

MARKER = "_compaction"


def plan(spark: SparkSession, path: str, target_bytes: int) -> DataFrame:
    """``(folder, path, length, bin)`` of the files to be rewritten; a bin number is one of the whole table."""
    below = F.substring(F.col("path"), len(listing.qualified(spark, path).rstrip("/")) + 1, 1 << 20)
    files = listing.list_files(spark, [path]).where(F.col("path").endswith(".parquet") & ~below.rlike("/[_.]"))
    files = files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "path", "length").where(F.col("length") < target_bytes)
    # One partition's files meet in one task: rows of two names and a number.
    order = Window.partitionBy("folder").orderBy(F.col("length").desc(), "path")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    files = files.withColumn("part", F.floor(F.coalesce(before, F.lit(0)) / target_bytes))
    files = files.withColumn("others", F.count(F.lit(1)).over(Window.partitionBy("folder", "part"))).where("others > 1")
    bins = files.select("folder", "part").distinct().withColumn("bin", F.xxhash64("folder", "part"))
    return files.join(bins, ["folder", "part"]).select("folder", "path", "length", "bin")


def compact(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> tuple[int, int]:
    """Compact the Parquet table at ``path``; returns how many files became how many."""
    finish_swaps(spark, path)
    staged = scratch_path(spark, "compaction-plan")
    plan(spark, path, target_bytes).write.parquet(staged)
    files = spark.read.parquet(staged)
    old: dict[str, list[str]] = {}
    for r in files.select("folder", "path").collect():  # one row a small file, as Spark's own file index holds
        old.setdefault(r["folder"], []).append(r["path"])
    if not old:
        return 0, 0
    n_bins = files.select("bin").distinct().count()
    paths = sorted(p for ps in old.values() for p in ps)
    rows = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*[glob_escape(p) for p in paths])
    columns = rows.columns
    rows = rows.select("*", plain_path(F.col("_metadata.file_path")).alias("__path"))
    numbered = files.select("bin").distinct().withColumn("__bin", F.row_number().over(Window.orderBy("bin")) - 1)  # one row a bin
    found = files.join(numbered, "bin").select(F.col("path").alias("__path"), "__bin", "folder")
    rows = rows.join(found, "__path").withColumn("__folder", F.sha1("folder"))
    version = uuid.uuid4().hex[:12]
    made = f"{path.rstrip('/')}/{MARKER}-{version}"
    (rows.repartitionById(n_bins, F.col("__bin").cast("int")).select(*[F.col(f"`{c}`") for c in columns], "__folder")
     .write.option("compression", "zstd").partitionBy("__folder").parquet(f"{made}/data"))
    swaps = {f: {"old": ps, "new": hashlib.sha1(f.encode()).hexdigest()} for f, ps in old.items()}
    _put(spark, f"{made}/swaps.json", json.dumps(swaps))
    finish_swaps(spark, path)
    return len(paths), n_bins


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make, make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    make, fs = _fs(spark, path)
    stream = fs.create(make(path + ".tmp"), True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.rename(make(path + ".tmp"), make(path))


def finish_swaps(spark: SparkSession, path: str) -> int:
    """Put the files of written compactions in place; returns how many partitions were swapped.

    Each step can be repeated: old files go once all new ones of the folder have come, and the marker goes last.
    A folder without its list of swaps was never finished and is dropped.
    """
    make, fs = _fs(spark, path)
    if not fs.exists(make(path)):
        return 0
    done = 0
    for s in fs.listStatus(make(path)):
        if not s.getPath().getName().startswith(MARKER + "-"):
            continue
        made = s.getPath().toString()
        if fs.exists(make(f"{made}/swaps.json")):
            swaps = json.loads("\n".join(r["value"] for r in spark.read.text(f"{made}/swaps.json").collect()))
            for folder, swap in swaps.items():
                source = make(f"{made}/data/__folder={swap['new']}")
                if fs.exists(source):
                    for f in fs.listStatus(source):
                        if f.getPath().getName().endswith(".parquet") and not fs.rename(f.getPath(), make(folder, f.getPath().getName())):
                            raise RuntimeError(f"could not move {f.getPath()} to {folder}")
                for p in swap["old"]:
                    fs.delete(make(p), False)
                done += 1
        fs.delete(make(made), True)
    return done
