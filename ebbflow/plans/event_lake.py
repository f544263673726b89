"""End-to-end runs: the event lake (half A) and the file governance DAG (half B).

Event lake, as Spark jobs:

1. list + probe + classify the source files (small, one row per file);
2. quarantine the failed files (one folder per run);
3. scan the good files once, process, and write the processed rows to a
   staging Parquet table under the shared checkpoint folder. This cuts the
   lineage (an executor lost later does not send the job back to the CSV
   files) and lets both branches read only the columns they need;
4. branch 1: rule-join routing -> one partitioned write of every table, or
   table by table if that fails, so that one table's failure stays its own;
5. branch 2: ad pre-aggregate -> one partitioned write (branches 1, 2 and the
   coverage counts run as concurrent jobs);
6. a one-row metrics frame of what was read and of the tables whose write
   succeeded.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.operators import aggregates as G
from ebbflow.operators import events as E
from ebbflow.operators import governance as V
from ebbflow.operators import reports as P
from ebbflow.operators import routing as R
from ebbflow.functions import columns as X
from ebbflow.session import ensure_shuffle_partitions, scratch_path
from ebbflow.sinks import parquet as W
from ebbflow.sinks import quarantine as Qn
from ebbflow.sinks import upsert as U
from ebbflow.sources import files as S
from ebbflow.sources.manifest import build_manifest


# Rough text/gzip size ratio of CSV exports, to size shuffles from file lengths.
GZIP_EXPANSION = 6


@dataclass
class EventLakeRun:
    metrics: DataFrame
    coverage: DataFrame
    processed_path: str
    events_path: str
    aggregates_path: str
    quarantine_path: str


LAYOUTS = ("partitioned", "table_folders")
BAD_ROW_MODES = ("keep", "quarantine", "fail")


def run_event_lake(spark: SparkSession, source_root: str | list[str], output_root: str,
                   clock: C.RunClock, dlq_location: str, rules: R.RuleSet | None = None, compression: str = "sniff",
                   date: str | None = None, hour: str | int | None = None,
                   tenants: list[str] | None = None,
                   quarantine_bytes: bool = True,
                   events_layout: str = "partitioned",
                   route_empty_tenant: bool = False,
                   normalize_activity: bool = True, on_bad_row: str = "keep") -> EventLakeRun:
    """One run over the source files. Arguments are checked before any work.

    Rows without a tenant are set aside in a quarantine folder of their own
    (``_quarantine_no_tenant``), and rows are routed on the trimmed, lower-case activity;
    ``route_empty_tenant=True, normalize_activity=False`` routes all of them by
    their exact activity, as upstream does. Rows whose epoch or JSON does not
    parse are noted with a reason in ``_quarantine_rejected``;
    ``on_bad_row``: ``keep`` goes on with their values as NULL, ``quarantine``
    leaves them out of the lake, ``fail`` ends the run before any table is
    written.
    """
    if on_bad_row not in BAD_ROW_MODES:
        raise ValueError(f"on_bad_row must be one of {BAD_ROW_MODES}")
    if events_layout not in LAYOUTS:
        raise ValueError(f"events_layout must be one of {LAYOUTS}")
    if hour is not None:
        S.parse_hour(hour)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        return _run(spark, source_root, output_root, clock, dlq_location, rules or R.RuleSet(), compression, date, hour,
                    tenants, quarantine_bytes, events_layout, route_empty_tenant, normalize_activity, on_bad_row)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def _run(spark, source_root, output_root, clock, dlq_location, rules, compression, date, hour, tenants,
         quarantine_bytes, events_layout, route_empty_tenant, normalize_activity, on_bad_row) -> EventLakeRun:
    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    scan = S.load_events(spark, source_root, compression=compression, date=date, hour=hour, tenants=tenants)
    file_stats = scan.files.groupBy().agg(
        F.count(F.lit(1)).alias("files_total"),
        F.sum(F.when(F.col("status") == S.STATUS_OK, 1).otherwise(0)).alias("files_ok"),
        F.sum(F.when(F.col("is_gzip"), F.col("length") * GZIP_EXPANSION).otherwise(F.col("length")))
        .alias("input_bytes")).first()
    # Shuffles downstream (aggregate, write layout) scale with the input.
    ensure_shuffle_partitions(spark, int(file_stats["input_bytes"] or 0))
    quarantine_path = f"{output_root}/_quarantine"
    q = Qn.quarantine_frame(scan.files, clock, dlq_location)
    if quarantine_bytes:  # keep a copy of each failed file, as the DLQ copy did
        Qn.write_parts(spark, q, f"{quarantine_path}_parts", clock.as_of)
        q = Qn.with_content(spark, q)
    Qn.write_quarantine(q, quarantine_path, clock.as_of)
    timings["discover_and_load_plan"] = time.perf_counter() - t0

    t1 = time.perf_counter()
    processed_path = scratch_path(spark, "processed")
    if scan.flagged is not None:
        # Good and malformed rows are counted in the same pass that stages the data.
        read = Observation("rows_read")
        flagged = scan.flagged.observe(
            read, F.count(F.when(~F.col("__malformed"), 1)).alias("n"),
            F.count(F.when(F.col("__malformed"), 1)).alias("bad"))
        rows = (flagged.where(~F.col("__malformed")).drop("_corrupt_record", "__malformed")
                .withColumn("prefix", X.tenant_from_path("filename")))
        if set(E.FILTER_COLUMNS) <= set(rows.columns):
            _stage(E.process_events(rows, clock), processed_path)
            counted = read.get  # the write succeeded, so its plan ran and the counts are there
            read_counts = (int(counted["n"]), int(counted["bad"]))
        else:
            # No file has a column that the filters need: no row passes, the
            # optimizer may skip the scan, and the rows are counted directly.
            _stage(E.process_events(scan.rows, clock), processed_path)
            r = scan.flagged.agg(F.count(F.when(~F.col("__malformed"), 1)).alias("n"),
                                 F.count(F.when(F.col("__malformed"), 1)).alias("bad")).first()
            read_counts = (int(r["n"]), int(r["bad"]))
    else:
        _stage(E.process_events(scan.rows, clock), processed_path)
        read_counts = (0, 0)
    staged = spark.read.parquet(processed_path)
    reason = E.reject_reason()
    # Columns that name the row and its values; the staged rows are still there in whole.
    rejected = staged.select("filename", "prefix", "adid", "created_at", "activity_kind", "publisher_parameters",
                             reason.alias("reject_reason")).where(F.col("reject_reason").isNotNull())
    Qn.write_quarantine(rejected, f"{quarantine_path}_rejected", clock.as_of)
    rows_rejected = spark.read.schema(rejected.schema).parquet(Qn.run_folder(f"{quarantine_path}_rejected", clock.as_of)).count()
    if rows_rejected and on_bad_row == "fail":
        raise ValueError(f"{rows_rejected} rows do not parse; they are in {quarantine_path}_rejected")
    if on_bad_row == "quarantine":
        staged = staged.where(reason.isNull())
    routing = {"normalize_activity": normalize_activity, "route_empty_tenant": route_empty_tenant}
    if not route_empty_tenant:
        Qn.write_quarantine(R.no_tenant_rows(staged), f"{quarantine_path}_no_tenant", clock.as_of)
    timings["process"] = time.perf_counter() - t1

    events_path = f"{output_root}/events"
    aggregates_path = f"{output_root}/aggregates"

    def route() -> dict[str, str]:
        """Error by table of the tables that could not be written."""
        t = time.perf_counter()
        routed = R.route_events(staged, rules, **routing)
        failed = isolated_write(routed, lambda part: W.write_routed(part, events_path, layout=events_layout))
        timings["route_and_write"] = time.perf_counter() - t
        return failed

    def cover() -> tuple[DataFrame, int]:
        t = time.perf_counter()
        path = scratch_path(spark, "coverage")
        _stage(R.routing_coverage(staged, rules, **routing), path)
        unrouted = int(R.unrouted_rows(staged, rules, **routing).first()["rows_unrouted"])
        timings["coverage"] = time.perf_counter() - t
        return spark.read.parquet(path), unrouted

    def aggregate() -> tuple[int, dict[str, str]]:
        """Rows written, and the error by table."""
        t = time.perf_counter()
        path = scratch_path(spark, "aggregates")
        _stage(G.ad_preagg_output(G.ad_preaggregate(staged, clock)), path)
        made = spark.read.parquet(path)
        failed = isolated_write(made, lambda part: W.write_aggregates(part, aggregates_path))
        n = made.where(~F.col("table_name").isin(list(failed))).count() if failed else made.count()
        timings["aggregate_and_write"] = time.perf_counter() - t
        return n, failed

    # The three branches read the staged table independently; they are
    # submitted as concurrent Spark jobs from driver threads, so small jobs
    # overlap instead of leaving executors idle between them.
    with ThreadPoolExecutor(max_workers=3) as pool:
        routed, covered, aggregated = [pool.submit(b) for b in (route, cover, aggregate)]
        failed_events, (coverage, unrouted), (aggregate_rows, failed_aggregates) = routed.result(), covered.result(), aggregated.result()

    if failed_events:
        lost = F.col("table_name").isin(list(failed_events)) & (F.col("status") == "written")
        coverage = coverage.withColumn("status", F.when(lost, F.lit("failed")).otherwise(F.col("status")))
    by_status = {r["status"]: r for r in coverage.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("routed_rows").alias("rows")).collect()}

    def of(status: str, what: str) -> int:
        return int(by_status[status][what] or 0) if status in by_status else 0

    failed_writes = [f"events {t}: {e}" for t, e in sorted(failed_events.items())]
    failed_writes += [f"aggregates {t}: {e}" for t, e in sorted(failed_aggregates.items())]
    metrics = spark.createDataFrame([(
        int(file_stats["files_total"] or 0), int(file_stats["files_ok"] or 0),
        int((file_stats["files_total"] or 0) - (file_stats["files_ok"] or 0)),
        read_counts[0], read_counts[1], rows_rejected, of("written", "rows"), unrouted, aggregate_rows,
        of("written", "tables"), of("empty", "tables"), of("failed", "tables"), failed_writes,
        {k: float(v) for k, v in timings.items()},
    )], "files_total bigint, files_ok bigint, files_failed bigint, rows_read bigint, "
        "rows_malformed bigint, rows_rejected bigint, partitioned_rows_written bigint, rows_unrouted bigint, "
        "aggregate_rows_written bigint, "
        "tables_written bigint, empty_tables bigint, failed_tables bigint, failed_writes array<string>, "
        "phase_seconds map<string,double>")
    return EventLakeRun(metrics, coverage, processed_path, events_path, aggregates_path, quarantine_path)


def _stage(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def isolated_write(df: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, str]:
    """Write all tables of ``df`` in one job; if that fails, in halves, and so on.

    Returns the error of each table that could not be written. A table that can
    be written is, whatever happens to the others; few bad tables among many
    cost a few jobs each, not one for every table.
    """
    failed: dict[str, str] = {}

    def attempt(part: DataFrame, tables: list | None) -> None:
        try:
            write(part)
            return
        except Exception as e:  # noqa: BLE001 - told apart by table below
            if tables is None:
                tables = sorted((r["table_name"] for r in df.select("table_name").distinct().collect()), key=str)  # tables of one run, no rows
            if len(tables) == 1:
                failed[tables[0]] = f"{type(e).__name__}: {e}"
                return
        for half in (tables[:len(tables) // 2], tables[len(tables) // 2:]):
            if half:
                own = F.col("table_name").isin([t for t in half if t is not None])
                attempt(df.where(own | F.col("table_name").isNull() if None in half else own), half)

    attempt(df, None)
    return failed


@dataclass
class GovernanceRun:
    processed_path: str
    failed_path: str
    processed: DataFrame
    failed: DataFrame


def run_governance(spark: SparkSession, manifest: DataFrame, clock: C.RunClock, output_root: str,
                   dlq_location: str,
                   previous_failed: DataFrame | None = None, incremental: bool = False) -> GovernanceRun:
    """stage -> validate -> good-file mart (partitioned by load_date, clustered
    by file_name) and dead-letter mart (partitioned by failure_date, keeping
    ``is_resolved`` of an earlier run). ``incremental`` merges both into what
    the folder holds (``sinks.upsert``): only partitions of new or changed files
    are rewritten, and what left the retention window stays."""
    validated = V.validate_files(V.stage_raw_files(manifest, clock), clock)
    good = V.processed_files(validated, clock)
    bad = V.carry_resolution(V.failed_files(validated, clock, dlq_location), previous_failed)
    ppath, fpath = f"{output_root}/processed_data", f"{output_root}/failed_files"
    if incremental:
        U.upsert(spark, good, ppath, ["file_name", "file_hash"], "load_date", ["load_timestamp", "record_count", "processing_status"],
                 kept=("inserted_at",), cluster_cols=("file_name",))
        U.upsert(spark, bad, fpath, ["file_name", "file_hash"], "failure_date", ["load_timestamp", "record_count", "failure_reason"],
                 kept=("dlq_inserted_at", "is_resolved"))
    else:
        W.write_clustered(good, ppath, "load_date", ["file_name"])
        W.write_partitioned(bad, fpath, ["failure_date"])
    p = W.read_partitioned(spark, ppath, {"load_date": "date"})
    f = W.read_partitioned(spark, fpath, {"failure_date": "date"})
    return GovernanceRun(ppath, fpath, p, f)


def governance_reports(run: GovernanceRun, clock: C.RunClock) -> dict[str, DataFrame]:
    return {
        "processing_stats": P.processing_stats(run.processed, run.failed),
        "dlq_summary": P.dlq_summary(run.failed),
        "write_stats": P.write_stats(run.processed),
    }


def manifest_from_sources(spark: SparkSession, source_root: str, include_content: bool = True) -> DataFrame:
    scan = S.load_events(spark, source_root, hash_bytes=True)
    return build_manifest(spark, scan, include_content=include_content)
