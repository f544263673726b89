"""File manifest (S10): one row per source file, the input of the governance DAG.

``file_name, load_timestamp, file_hash, record_count, raw_content``:

* ``load_timestamp`` = the file's modification time;
* ``file_hash``      = SHA-256 of the stored bytes, computed by the streaming
  probe (``probe_files(hash_bytes=True)``), not by loading files into cells;
* ``record_count``   = data records the CSV scan found in the file, well-formed
  and malformed together (one aggregate per file, combined map-side);
* ``raw_content``    = the decompressed text (``text`` reader, ``wholetext``),
  only when ``include_content``; files are at most a few hundred MB each, one
  cell per file. Without content there is ``content_bytes``, the length of a
  readable file, and the content flag comes from that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.session import scratch_path
from ebbflow.sources import blocks
from ebbflow.sources.files import PASSTHROUGH_OPTIONS, STATUS_OK, ScanResult
from ebbflow.sources.paths import glob_escape, plain_path


def _read_by_tasks(name: Column, path: Column, padded: Column) -> Column:
    """Files whose text tasks read themselves, of paths that they can open."""
    return (name.rlike("^[_.]") | padded) & path.startswith("file:")


def _content(spark: SparkSession, files: DataFrame, compression: str) -> DataFrame:
    ok = files.where(F.col("status") == F.lit(STATUS_OK))
    # Spark's text source reads neither hidden names nor gzip members followed by padding.
    own = _read_by_tasks(F.col("file_name"), F.col("path"), F.coalesce("padded", F.lit(False)))
    groups: dict[bool, list[str]] = {}
    by_tasks = 0
    for r in ok.select("is_gzip", "path", own.alias("own")).collect():  # file metadata, one row per file
        if r["own"]:
            by_tasks += 1
        else:
            groups.setdefault(bool(r["is_gzip"]), []).append(r["path"])
    frames = []
    if by_tasks:
        gzipped = F.lit(False) if compression == "none" else F.coalesce("is_gzip", F.lit(False))
        frames.append(blocks.whole_texts(ok.where(own).select("path", gzipped.alias("gzipped")).repartition(min(by_tasks, 10_000))))
    for is_gzip, paths in sorted(groups.items()):
        reader = spark.read
        if compression == "none" or (compression == "sniff" and not is_gzip):
            reader = reader.options(**PASSTHROUGH_OPTIONS)
        frames.append(reader.text([glob_escape(p) for p in sorted(paths)], wholetext=True).select(
            plain_path(F.col("_metadata.file_path")).alias("path"),
            F.col("value").alias("raw_content")))
    if not frames:
        return spark.createDataFrame([], "path string, raw_content string")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def build_manifest(spark: SparkSession, scan: ScanResult, include_content: bool = True,
                   compression: str = "sniff") -> DataFrame:
    files = scan.files.select("path", "file_name", "length", "modification_time", "file_hash", "status")
    if scan.flagged is None:
        counts = spark.createDataFrame([], "path string, n bigint")
    else:  # good and malformed rows in one pass
        counts = scan.flagged.groupBy(F.col("filename").alias("path")).agg(
            F.count(F.when(F.col("__malformed").isNotNull(), 1)).alias("n"))
    m = files.join(counts, "path", "left")
    record_count = F.when(F.col("status") == F.lit(STATUS_OK), F.coalesce(F.col("n"), F.lit(0)))
    columns = ["file_name", F.col("modification_time").alias("load_timestamp"), "file_hash",
               record_count.cast("bigint").alias("record_count")]
    if include_content:
        m = m.join(_content(spark, scan.files, compression), "path", "left")
        columns.append(F.when(F.col("length") == 0, F.lit("")).otherwise(F.col("raw_content")).alias("raw_content"))
    else:
        columns += [F.lit(None).cast("string").alias("raw_content"),
                    F.when(F.col("status") == F.lit(STATUS_OK), F.col("length")).alias("content_bytes")]
    made = m.select(*columns)
    path = scratch_path(spark, "manifest")  # both marts read it, so it is made once
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)
