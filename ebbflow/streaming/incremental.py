"""Incremental (hourly) ingestion with Structured Streaming.

The upstream job re-lists and re-reads every file under the prefix on each
run. Here a file-source stream over the listing keeps the set of files
already seen in its checkpoint, so each run (``trigger(availableNow=True)``)
picks up only new files and then stops. Each micro-batch hands its *paths*
(content pruned) to the batch loader, so new files get the same probe,
quarantine, union-by-name scan and processing as a batch run, and its part of
the ad pre-aggregate is added.

Exactly-once output. Every micro-batch writes to its own
``batch_id=<query>-<n>`` folders with overwrite, so a retried batch replaces
its own output. A ledger of files (path, length, modification time) is kept
with the output: a run with a new checkpoint sees all files again, and those
that another batch has ingested are left out.

Zero-byte files and hidden names never reach a file stream. Each run lists them
afterwards, quarantines the empty ones and ingests the others, if not in the ledger.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.operators import aggregates as G
from ebbflow.operators import events as E
from ebbflow.operators import routing as R
from ebbflow.session import scratch_path
from ebbflow.sinks import parquet as W
from ebbflow.sinks import quarantine as Qn
from ebbflow.sources import files as S
from ebbflow.sources import listing
from ebbflow.sources.paths import glob_escape, norm_path

LEDGER = "path string, length bigint, modification_time timestamp, batch_id string"


def _paths(batch: DataFrame) -> list[str]:
    # One row per new file of this micro-batch (bounded by maxFilesPerTrigger).
    return [r["path"] for r in batch.select(norm_path(F.col("path")).alias("path")).collect()]


def _unseen(spark: SparkSession, files: DataFrame, output_root: str, batch: str) -> DataFrame:
    """Files of the listing that no other batch has ingested."""
    try:
        known = spark.read.schema(LEDGER).parquet(f"{output_root}/_files").where(F.col("batch_id") != batch)
    except AnalysisException:  # no ledger yet
        return files
    return files.join(known, ["path", "length", "modification_time"], "left_anti").select(*files.columns)


def _note(files: DataFrame, output_root: str, batch: str) -> None:
    """The last write of a batch: only what is wholly ingested is in the ledger."""
    files.select("path", "length", "modification_time").write.mode("overwrite").parquet(f"{output_root}/_files/batch_id={batch}")


def _listed(spark: SparkSession, paths: list[str], suffix: str) -> DataFrame:
    """The listing of single files."""
    if all(listing.can_list(p) for p in paths[:1]):
        return S.list_source_files(spark, paths, suffix)
    return S.list_source_files(spark, [glob_escape(p) for p in paths], suffix)


def process_batch(spark: SparkSession, paths: list[str], batch_id: int | str, output_root: str,
                  clock: C.RunClock, dlq_location: str, suffix: str = C.SOURCE_SUFFIX, compression: str = "sniff",
                  route: bool = False, rules: R.RuleSet | None = None, normalize_activity: bool = True,
                  route_empty_tenant: bool = False) -> None:
    """One micro-batch: probe, quarantine, scan, process and aggregate the given
    files and (optionally) route them. Every output goes to this batch's own
    ``batch_id`` partition with overwrite, so running a batch again (as
    Spark does after a failure) replaces its output instead of duplicating it."""
    batch = f"b-{batch_id}"
    found = _unseen(spark, _listed(spark, paths, suffix), output_root, batch)
    staged_files = scratch_path(spark, "batch-files")
    probed = S.classify_files(S.probe_files(found))
    probed.write.parquet(staged_files)
    files = spark.read.schema(probed.schema).parquet(staged_files)
    (Qn.quarantine_frame(files, clock, dlq_location).write.mode("overwrite").option("compression", "zstd")
     .parquet(f"{output_root}/_quarantine/batch_id={batch}"))
    scan = S.scan_csv(spark, files, compression)
    processed = E.process_events(scan.rows, clock)
    processed_path = f"{output_root}/processed/batch_id={batch}"
    processed.write.mode("overwrite").option("compression", "zstd").parquet(processed_path)
    staged = spark.read.parquet(processed_path)
    (G.ad_preaggregate(staged, clock).write.mode("overwrite").option("compression", "zstd")
     .parquet(f"{output_root}/aggregates/batch_id={batch}"))
    if route:
        routed = R.route_events(staged, rules or R.RuleSet(), normalize_activity=normalize_activity,
                                route_empty_tenant=route_empty_tenant).withColumn("batch_id", F.lit(batch))
        if not route_empty_tenant:
            (R.no_tenant_rows(staged).write.mode("overwrite").option("compression", "zstd")
             .parquet(f"{output_root}/_no_tenant/batch_id={batch}"))
        W.write_partitioned(routed, f"{output_root}/routed", ["table_name", "date", "batch_id"])
    _note(files, output_root, batch)


def ingest_new_files(spark: SparkSession, source_root: str, output_root: str, checkpoint: str,
                     clock: C.RunClock, dlq_location: str, max_files_per_trigger: int = 500,
                     suffix: str = C.SOURCE_SUFFIX, compression: str = "sniff",
                     route: bool = False, rules: R.RuleSet | None = None, normalize_activity: bool = True,
                     route_empty_tenant: bool = False) -> int:
    """Process every file not seen by earlier runs; returns micro-batches run.

    With ``route=True`` each micro-batch also writes its routed rows under
    ``routed/table_name=<t>/date=<d>/batch_id=<n>/``: dynamic overwrite then
    replaces only that batch's partitions, so a retried batch is idempotent and
    a later batch never erases rows an earlier batch wrote for the same date."""
    batches = {"n": 0}

    def handle(batch: DataFrame, batch_id: int) -> None:
        paths = _paths(batch)
        if not paths:
            return
        batches["n"] += 1
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        # Another checkpoint counts its batches from 0 again.
        key = hashlib.sha256(f"{query} {checkpoint}".encode()).hexdigest()[:12]
        process_batch(spark, paths, f"{key}-{batch_id}", output_root, clock, dlq_location, suffix, compression, route, rules,
                      normalize_activity, route_empty_tenant)

    stream = (spark.readStream.format("binaryFile")
              .schema("path string, modificationTime timestamp, length bigint, content binary")
              .option("pathGlobFilter", f"*{suffix}")
              .option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .load(source_root)
              .select("path"))
    q = (stream.writeStream.foreachBatch(handle)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    quarantine_empty_files(spark, source_root, output_root, clock, dlq_location, suffix)
    # Names that start with _ or . never reach a file stream either; they make a batch of their own.
    hidden = S.list_source_files(spark, source_root, suffix).where("length > 0 AND file_name RLIKE '^[_.]' OR path RLIKE '/[_.][^/]*/'")
    hidden = _unseen(spark, hidden.where("length > 0"), output_root, "").select("path", "modification_time").collect()
    names = sorted(f"{r['path']} {r['modification_time']}" for r in hidden)
    for at in range(0, len(names), max_files_per_trigger):
        part = sorted(hidden, key=lambda r: r["path"])[at:at + max_files_per_trigger]
        key = hashlib.sha256("\n".join(names[at:at + max_files_per_trigger]).encode()).hexdigest()[:12]
        batches["n"] += 1
        process_batch(spark, [r["path"] for r in part], f"hidden-{key}", output_root, clock, dlq_location, suffix, compression, route,
                      rules, normalize_activity, route_empty_tenant)
    return batches["n"]


def quarantine_empty_files(spark: SparkSession, source_root: str, output_root: str, clock: C.RunClock,
                           dlq_location: str, suffix: str = C.SOURCE_SUFFIX) -> None:
    """Zero-byte files that no run has noted yet."""
    empty = S.list_source_files(spark, source_root, suffix).where("length = 0")
    empty = _unseen(spark, empty, output_root, "")
    names = sorted(f"{r['path']} {r['modification_time']}" for r in empty.collect())
    if not names:
        return
    batch = "empty-" + hashlib.sha256("\n".join(names).encode()).hexdigest()[:12]
    failed = empty.withColumn("status", F.lit("EMPTY_FILE"))
    (Qn.quarantine_frame(failed, clock, dlq_location).write.mode("overwrite").option("compression", "zstd")
     .parquet(f"{output_root}/_quarantine/batch_id={batch}"))
    _note(empty, output_root, batch)


def read_ingested(spark: SparkSession, output_root: str) -> DataFrame:
    return _read(spark, output_root, "processed")


def read_routed(spark: SparkSession, output_root: str) -> DataFrame:
    routed = _read(spark, output_root, "routed")
    return routed.withColumn("date", F.col("date").cast("date")).drop("batch_id")


def read_aggregates(spark: SparkSession, output_root: str, clock: C.RunClock | None = None) -> DataFrame:
    """The ad pre-aggregate of all batches: counts and revenue add up. With a
    clock, dates before its window are left out, as a full run would leave them.
    ``streaming.rolling`` keeps the same table without summing every batch again."""
    keys = [name for _, name in G.GROUP_KEYS]
    made = _read(spark, output_root, "aggregates")
    if clock is not None:
        made = made.where(G.lookback_filter(clock))
    return made.groupBy(*keys).agg(
        F.sum("ad_count").cast("bigint").alias("ad_count"), F.sum("ad_revenue").alias("ad_revenue"),
        F.max("aging").alias("aging"), F.max("_time").alias("_time"))


def _read(spark: SparkSession, output_root: str, name: str) -> DataFrame:
    # Batches may hold different columns when headers drift.
    return spark.read.option("basePath", f"{output_root}/{name}").option("mergeSchema", "true").parquet(f"{output_root}/{name}")
