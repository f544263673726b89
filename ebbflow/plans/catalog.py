"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the provided tables through the adapters, runs the engine's
operators unchanged, and only renames / rounds at the very end where a
float has to be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.config import RunClock
from ebbflow.functions import columns as X
from ebbflow.operators import aggregates as G
from ebbflow.operators import dead_letters as DL
from ebbflow.operators import distinct_state as DS
from ebbflow.operators import events as E
from ebbflow.operators import governance as V
from ebbflow.operators import overlap as OV
from ebbflow.operators import quality as Q
from ebbflow.operators import reports as P
from ebbflow.operators import routing as R
from ebbflow.operators import types as T
from ebbflow.plans import adapters as A
from ebbflow.plans import event_lake as EL
from ebbflow.plans import exports as XP
from ebbflow.session import apply_base_conf, scratch_path
from ebbflow.sinks import compact as CP
from ebbflow.sinks import curve as CU
from ebbflow.sinks import parquet as W
from ebbflow.sinks import quarantine as QN
from ebbflow.sources import files as S
from ebbflow.streaming import freshness as FR
from ebbflow.streaming import incremental as INC
from ebbflow.streaming import rolling as ROLL

Query = Callable[[SparkSession, str], DataFrame]

_FRAMES: dict[tuple, DataFrame] = {}


def _app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        return str(id(spark))


def _shared(fn):
    """Define a base frame once per (session, tables folder): the plan is built
    once and reused by every query that starts from it (frames are immutable)."""
    def wrapper(spark: SparkSession, sf: str) -> DataFrame:
        key = (_app_id(spark), sf, fn.__name__)
        if key not in _FRAMES:
            _FRAMES[key] = fn(spark, sf)
        return _FRAMES[key]
    wrapper.__name__ = fn.__name__
    return wrapper


# ---------------------------------------------------------------- events side
@_shared
def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    apply_base_conf(spark)
    return E.attach_tenant(A.raw_events(A.table(spark, sf, "events")))


@_shared
def processed_events(spark: SparkSession, sf: str) -> DataFrame:
    return E.process_events(raw_events(spark, sf), A.EVENTS_CLOCK)


def _round_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("ad_revenue", F.round("ad_revenue", 6))


def q_json_params(spark, sf):
    return E.json_params(raw_events(spark, sf))


def q_epoch_to_date(spark, sf):
    return E.epoch_dates(raw_events(spark, sf))


def q_install_age_days(spark, sf):
    return E.install_age_days(processed_events(spark, sf))


def q_filter_activity(spark, sf):
    return processed_events(spark, sf)


def q_tenant_from_path(spark, sf):
    return raw_events(spark, sf).select("filename", "prefix").distinct()


def q_distinct_tenants(spark, sf):
    return E.distinct_tenants(processed_events(spark, sf))


def q_exclude_columns(spark, sf):
    return E.exclude_columns(processed_events(spark, sf))


def q_route_events(spark, sf):
    return R.route_events(processed_events(spark, sf))


def q_routing_coverage(spark, sf):
    return R.routing_coverage(processed_events(spark, sf))


def q_ad_preagg(spark, sf):
    return _round_revenue(G.ad_preaggregate(processed_events(spark, sf), A.EVENTS_CLOCK))


def q_ad_preagg_output(spark, sf):
    return _round_revenue(G.ad_preagg_output(G.ad_preaggregate(processed_events(spark, sf), A.EVENTS_CLOCK)))


def q_dq_raw_events(spark, sf):
    return E.raw_event_violations(raw_events(spark, sf))


def q_dq_schema_contract(spark, sf):
    return E.schema_contract(raw_events(spark, sf))


# ------------------------------------------------------------ governance side
@_shared
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    apply_base_conf(spark)
    return A.file_manifest(A.table(spark, sf, "documents"))


@_shared
def staged(spark, sf):
    return V.stage_raw_files(manifest(spark, sf), A.FILES_CLOCK)


@_shared
def validated(spark, sf):
    return V.validate_files(staged(spark, sf), A.FILES_CLOCK)


@_shared
def good_files(spark, sf):
    return V.processed_files(validated(spark, sf), A.FILES_CLOCK)


@_shared
def bad_files(spark, sf):
    return V.failed_files(validated(spark, sf), A.FILES_CLOCK, A.DLQ_LOCATION)


def _daily_by_load_date(spark, sf) -> DataFrame:
    ok = good_files(spark, sf).select(F.to_date("load_timestamp").alias("load_date"),
                                      F.lit(1).alias("ok"), F.lit(0).alias("bad"))
    bad = bad_files(spark, sf).select(F.to_date("load_timestamp").alias("load_date"),
                                      F.lit(0).alias("ok"), F.lit(1).alias("bad"))
    return (ok.unionByName(bad).groupBy("load_date")
            .agg(F.sum("ok").cast("bigint").alias("successful_files"),
                 F.sum("bad").cast("bigint").alias("failed_files")))


def q_stg_raw_files(spark, sf):
    return staged(spark, sf)


def q_validate_files(spark, sf):
    return validated(spark, sf)


def q_processed_files(spark, sf):
    return good_files(spark, sf)


def q_failed_files(spark, sf):
    return bad_files(spark, sf)


def q_dlq_path(spark, sf):
    f = bad_files(spark, sf)
    base = F.lit(A.DLQ_LOCATION)
    return f.select(
        "file_name",
        X.dlq_path(base, "failed_timestamp", "file_name", "flat").alias("dlq_flat"),
        X.dlq_path(base, "failed_timestamp", "file_name", "day").alias("dlq_day"),
        X.dlq_path(base, "failed_timestamp", "file_name", "hour").alias("dlq_hour"),
    )


def q_content_checks(spark, sf):
    c = V.content_checks(manifest(spark, sf))
    return c.select("file_name", "is_valid", F.size("errors").alias("n_errors"),
                    F.array_join("errors", "|").alias("error_list"),
                    F.array_join("warnings", "|").alias("warning_list"))


def q_dq_not_null(spark, sf):
    return Q.not_null_counts(good_files(spark, sf))


def q_dq_unique(spark, sf):
    return Q.unique_violations(good_files(spark, sf))


def q_dq_accepted_values(spark, sf):
    return Q.accepted_values_violations(validated(spark, sf))


def q_dq_positive(spark, sf):
    return Q.greater_than_zero_violations(validated(spark, sf))


def q_dq_no_duplicates(spark, sf):
    return Q.duplicate_files(good_files(spark, sf))


def q_dq_checks(spark, sf):
    return Q.run_checks(good_files(spark, sf))


def q_dq_freshness(spark, sf):
    return Q.freshness(good_files(spark, sf), A.FILES_CLOCK)


def q_processing_stats(spark, sf):
    return P.processing_stats(good_files(spark, sf), bad_files(spark, sf))


def q_dlq_summary(spark, sf):
    return P.dlq_summary(bad_files(spark, sf))


def q_dlq_unresolved(spark, sf):
    return P.dlq_unresolved(bad_files(spark, sf))


def q_severity_buckets(spark, sf):
    counts = (bad_files(spark, sf)
              .groupBy(F.to_date("load_timestamp").alias("load_date"), "failure_reason")
              .agg(F.count(F.lit(1)).alias("failure_count")))
    return counts.withColumn("severity", X.severity("failure_count"))


def q_success_rate(spark, sf):
    d = _daily_by_load_date(spark, sf)
    return d.withColumn("success_rate", X.success_rate("successful_files", "failed_files"))


def q_quality_rating(spark, sf):
    d = _daily_by_load_date(spark, sf)
    r = d.select("load_date", X.success_rate("successful_files", "failed_files").alias("success_rate"))
    return r.withColumn("quality_rating", X.quality_rating("success_rate"))


def q_read_stats(spark, sf):
    return P.read_stats(staged(spark, sf))


def q_write_stats(spark, sf):
    return P.write_stats(good_files(spark, sf))


def q_run_manifest(spark, sf):
    return P.run_manifest(good_files(spark, sf), bad_files(spark, sf), A.FILES_CLOCK)


def q_dedupe_latest(spark, sf):
    return V.dedupe_latest(manifest(spark, sf))


QUERIES: dict[str, Query] = {
    "json_params": q_json_params,
    "epoch_to_date": q_epoch_to_date,
    "install_age_days": q_install_age_days,
    "filter_activity": q_filter_activity,
    "tenant_from_path": q_tenant_from_path,
    "distinct_tenants": q_distinct_tenants,
    "exclude_columns": q_exclude_columns,
    "route_events": q_route_events,
    "routing_coverage": q_routing_coverage,
    "ad_preagg": q_ad_preagg,
    "ad_preagg_output": q_ad_preagg_output,
    "dq_raw_events": q_dq_raw_events,
    "dq_schema_contract": q_dq_schema_contract,
    "stg_raw_files": q_stg_raw_files,
    "validate_files": q_validate_files,
    "processed_files": q_processed_files,
    "failed_files": q_failed_files,
    "dlq_path": q_dlq_path,
    "content_checks": q_content_checks,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_positive": q_dq_positive,
    "dq_no_duplicates": q_dq_no_duplicates,
    "dq_freshness": q_dq_freshness,
    "dq_checks": q_dq_checks,
    "processing_stats": q_processing_stats,
    "dlq_summary": q_dlq_summary,
    "dlq_unresolved": q_dlq_unresolved,
    "severity_buckets": q_severity_buckets,
    "success_rate": q_success_rate,
    "quality_rating": q_quality_rating,
    "read_stats": q_read_stats,
    "write_stats": q_write_stats,
    "run_manifest": q_run_manifest,
    "dedupe_latest": q_dedupe_latest,
}


# ------------------------------------------------- file sources (round trip)

WINDOW_DATE = "2024-01-05"
WINDOW_TENANTS = [A.ADAPTER_TENANTS[0], A.ADAPTER_TENANTS[3]]


def _root(spark, sf):
    apply_base_conf(spark)
    return XP.export_root(spark, sf)


def _basename(c: str = "filename"):
    return F.element_at(F.split(c, "/"), -1)


def _scan(spark, sf, **kw) -> S.ScanResult:
    return S.load_events(spark, _root(spark, sf), **kw)


def q_discover_files(spark, sf):
    listing = S.list_source_files(spark, _root(spark, sf))
    return listing.select("file_name", X.tenant_from_path("path").alias("prefix"),
                          (F.col("length") == 0).alias("is_empty"))


def q_csv_scan(spark, sf):
    rows = _scan(spark, sf).rows
    return rows.select(*[c for c in rows.columns if c != "filename"], _basename().alias("file_name"))


def q_union_by_name(spark, sf):
    rows = _scan(spark, sf).rows
    return rows.groupBy(_basename().alias("file_name")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("device_type").alias("with_device_type"),
        F.count("extra").alias("with_extra"))


def q_malformed_rows(spark, sf):
    bad = _scan(spark, sf).bad_rows
    return bad.groupBy(_basename().alias("file_name")).agg(F.count(F.lit(1)).alias("malformed_rows"))


def q_misnamed_gz_scan(spark, sf):
    """Files named ``.gz`` are told apart by their bytes: rows of each, and whether it is gzip."""
    scan = _scan(spark, sf)
    rows = scan.rows.groupBy(_basename().alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(scan.files.select("file_name", "is_gzip"), "file_name")


def q_file_provenance(spark, sf):
    rows = _scan(spark, sf).rows
    return rows.groupBy(_basename().alias("file_name"), "prefix").agg(F.count(F.lit(1)).alias("n_rows"))


def q_normalize_columns(spark, sf):
    rows = _scan(spark, sf).rows.drop("filename", "prefix")
    stats = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns])
    return stats.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("bigint").alias("non_null_values"))
        for c in rows.columns])))


def q_dq_schema_contract_files(spark, sf):
    return E.schema_contract(_scan(spark, sf).rows)


def q_file_isolation(spark, sf):
    files = _scan(spark, sf).files
    return files.select("file_name", "status", "is_gzip")


def q_quarantine_files(spark, sf):
    q = QN.quarantine_frame(_scan(spark, sf).files, A.EVENTS_CLOCK, A.DLQ_LOCATION)
    q = QN.with_content(spark, q)
    return q.select("file_name", "dlq_path", "reason", "length",
                    F.length("content").cast("bigint").alias("content_bytes"))


def q_source_window(spark, sf):
    rows = _scan(spark, sf, date=WINDOW_DATE, tenants=WINDOW_TENANTS).rows
    return rows.select("adid", "created_at", "activity_kind", _basename().alias("file_name"), "prefix")


def q_empty_input(spark, sf):
    """Processed rows of a window without files, of one with files, and of all files."""
    def processed(window: str, **kw) -> DataFrame:
        p = E.process_events(_scan(spark, sf, **kw).rows, A.EVENTS_CLOCK)
        return p.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("prefix").alias("n_tenants")).select(
            F.lit(window).alias("window"), "n_rows", "n_tenants")

    return processed("none", date="2030-01-01").unionByName(processed("day", date=WINDOW_DATE)).unionByName(processed("all"))


def q_file_manifest(spark, sf):
    m = EL.manifest_from_sources(spark, _root(spark, sf))
    lines = F.length("raw_content") - F.length(F.replace("raw_content", F.lit("\n"), F.lit("")))
    return m.select("file_name", "record_count",
                    F.col("file_hash").isNotNull().alias("has_hash"),
                    # The stored bytes of a plain file are its text.
                    F.when(~F.regexp_extract("file_name", "^[^_-]*", 0).isin(XP.GZIP_TENANTS), F.col("file_hash")).alias("plain_hash"),
                    F.when(F.col("raw_content") != "", F.sha2("raw_content", 256)).alias("content_sha256"),
                    F.when(F.col("raw_content") != "", F.length("raw_content").cast("bigint")).alias("content_chars"),
                    F.when(F.col("raw_content") != "", lines.cast("bigint")).alias("content_lines"))


def q_partitioned_write(spark, sf):
    path = scratch_path(spark, "routed")
    W.write_routed(R.route_events(processed_events(spark, sf)), path)
    return W.read_partitioned(spark, path, {"date": "date", "table_name": "string"})


def q_agg_write(spark, sf):
    path = scratch_path(spark, "aggregates")
    W.write_aggregates(G.ad_preagg_output(G.ad_preaggregate(processed_events(spark, sf), A.EVENTS_CLOCK)), path)
    return _round_revenue(W.read_partitioned(spark, path, {"date": "date", "table_name": "string"}))


def q_clustered_write(spark, sf):
    path = scratch_path(spark, "processed_data")
    W.write_clustered(good_files(spark, sf), path, "load_date", ["file_name"])
    return W.read_partitioned(spark, path, {"load_date": "date"})


def q_run_metrics(spark, sf):
    out = scratch_path(spark, "lake")
    run = EL.run_event_lake(spark, _root(spark, sf), out, A.EVENTS_CLOCK, A.DLQ_LOCATION, route_empty_tenant=True, normalize_activity=False)
    return run.metrics.select("*", F.size("failed_writes").cast("bigint").alias("n_failed_writes")).drop(
        "phase_seconds", "failed_writes")


def q_governance_run(spark, sf):
    """Files -> manifest -> staged/validated -> both marts written and read back."""
    m = EL.manifest_from_sources(spark, _root(spark, sf))
    run = EL.run_governance(spark, m, A.FILES_CLOCK, scratch_path(spark, "governance"), A.DLQ_LOCATION)
    return P.run_manifest(run.processed, run.failed, A.FILES_CLOCK).select(
        "file_name", "outcome", "failure_reason")


QUERIES.update({
    "governance_run": q_governance_run,
    "discover_files": q_discover_files,
    "csv_scan": q_csv_scan,
    "union_by_name": q_union_by_name,
    "malformed_rows": q_malformed_rows,
    "misnamed_gz_scan": q_misnamed_gz_scan,
    "file_provenance": q_file_provenance,
    "normalize_columns": q_normalize_columns,
    "file_isolation": q_file_isolation,
    "dq_schema_contract_files": q_dq_schema_contract_files,
    "quarantine_files": q_quarantine_files,
    "source_window": q_source_window,
    "empty_input": q_empty_input,
    "file_manifest": q_file_manifest,
    "partitioned_write": q_partitioned_write,
    "agg_write": q_agg_write,
    "clustered_write": q_clustered_write,
    "run_metrics": q_run_metrics,
})


# ------------------------------------------------------------ streaming


def q_incremental_ingest(spark, sf):
    root = _root(spark, sf)
    out, ckpt = scratch_path(spark, "ingest"), scratch_path(spark, "ingest-ckpt")
    INC.ingest_new_files(spark, root, out, ckpt, A.EVENTS_CLOCK, A.DLQ_LOCATION, max_files_per_trigger=64)
    again = INC.ingest_new_files(spark, root, out, ckpt, A.EVENTS_CLOCK, A.DLQ_LOCATION, max_files_per_trigger=64)
    rows = INC.read_ingested(spark, out)
    return (rows.groupBy(_basename().alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("second_run_batches", F.lit(again).cast("bigint")))


def q_incremental_routed(spark, sf):
    root = _root(spark, sf)
    out, ckpt = scratch_path(spark, "ingest-routed"), scratch_path(spark, "ingest-routed-ckpt")
    INC.ingest_new_files(spark, root, out, ckpt, A.EVENTS_CLOCK, A.DLQ_LOCATION, max_files_per_trigger=64, route=True,
                         normalize_activity=False, route_empty_tenant=True)
    routed = INC.read_routed(spark, out)
    return routed.select(*[c for c in routed.columns if c != "filename"], _basename().alias("file_name"))


def q_incremental_aggregates(spark, sf):
    """The ad pre-aggregate kept up by micro-batches, two runs over the same files."""
    root = _root(spark, sf)
    out, ckpt = scratch_path(spark, "ingest-agg"), scratch_path(spark, "ingest-agg-ckpt")
    INC.ingest_new_files(spark, root, out, ckpt, A.EVENTS_CLOCK, A.DLQ_LOCATION, max_files_per_trigger=64)
    # A new checkpoint sees every file again; the ledger of files keeps them from counting twice.
    INC.ingest_new_files(spark, root, out, scratch_path(spark, "ingest-agg-ckpt2"), A.EVENTS_CLOCK, A.DLQ_LOCATION)
    return _round_revenue(G.ad_preagg_output(INC.read_aggregates(spark, out)))


def q_route_rules_table(spark, sf):
    """Routing with the rules read from a table."""
    path = scratch_path(spark, "rules")
    R.RuleSet().frame(spark).write.parquet(path)
    return R.route_events(processed_events(spark, sf), R.RuleSet.from_frame(spark.read.parquet(path)))


def q_no_tenant(spark, sf):
    """Rows whose file has no tenant, set aside instead of routed."""
    p = processed_events(spark, sf)
    aside = R.no_tenant_rows(p).select("adid", "created_at", "activity_kind", "filename", "reason")
    routed = R.route_events(p, route_empty_tenant=False)
    return aside.withColumn("n_routed", F.lit(routed.where(F.col("table_name").startswith("_")).count()).cast("long"))


QUERIES["incremental_aggregates"] = q_incremental_aggregates
QUERIES["route_rules_table"] = q_route_rules_table
QUERIES["no_tenant"] = q_no_tenant
QUERIES["incremental_ingest"] = q_incremental_ingest
QUERIES["incremental_routed"] = q_incremental_routed


# ------------------------------------------- tables kept up by runs, types, rejects


def q_csv_scan_split(spark, sf):
    """The scan with plain files read as many ranges of whole records."""
    rows = _scan(spark, sf, split_bytes=4096).rows
    return rows.select(*[c for c in rows.columns if c != "filename"], _basename().alias("file_name"))


def q_rejected_rows(spark, sf):
    return E.rejected_rows(raw_events(spark, sf)).select("adid", "created_at", "publisher_parameters", "filename", "reject_reason")


def q_inferred_types(spark, sf):
    """Types of each file's columns, merged to those of all files."""
    rows = _scan(spark, sf).rows.drop("prefix")
    return T.inferred_types(T.merge_type_bits(T.column_type_bits(rows, by=["filename"])))


ROLLING_FIRST_CLOCK = RunClock("2024-01-10 00:00:00")  # 31 days before EVENTS_CLOCK


def q_rolling_aggregates(spark, sf):
    """Two runs 31 days apart, the second with late data for the first one's dates, and the second run repeated."""
    p = processed_events(spark, sf)
    first = (F.col("date") < F.lit("2024-01-21").cast("date")) & F.substring("created_at", -1, 1).isin("0", "2", "4", "6", "8")
    root = scratch_path(spark, "rolling-state")
    ROLL.merge_batch(spark, root, p.where(first), ROLLING_FIRST_CLOCK, "first")
    for _ in range(2):
        ROLL.merge_batch(spark, root, p.where(~F.coalesce(first, F.lit(False))), A.EVENTS_CLOCK, "second")
    return _round_revenue(ROLL.read_rolling(spark, root))


MARTS_FIRST_CLOCK = RunClock("2024-01-30 15:00:00")


def q_incremental_marts(spark, sf):
    """The good-file mart after two runs: the first one a day earlier, when some counts were other ones."""
    m = manifest(spark, sf)
    early = m.where(F.col("load_timestamp") <= F.lit(MARTS_FIRST_CLOCK.as_of).cast("timestamp")).withColumn(
        "record_count", F.when(F.col("record_count") % 10 == 3, F.col("record_count") - 1).otherwise(F.col("record_count")))
    out = scratch_path(spark, "incremental-marts")
    EL.run_governance(spark, early, MARTS_FIRST_CLOCK, out, A.DLQ_LOCATION, incremental=True)
    return EL.run_governance(spark, m, A.FILES_CLOCK, out, A.DLQ_LOCATION, incremental=True).processed


def q_compacted_write(spark, sf):
    """Routed tables written in many small files, then compacted."""
    path = scratch_path(spark, "routed-small")
    R.route_events(processed_events(spark, sf)).repartition(6).write.partitionBy("table_name", "date").parquet(path)
    CP.compact(spark, path, target_bytes=1 << 20)
    return W.read_partitioned(spark, path, {"date": "date", "table_name": "string"})


def q_dead_letters(spark, sf):
    """Ten documents are loads of one file; states of two halves of the loads are merged."""
    def of(frame):
        return frame.withColumn("file_name", F.regexp_replace("file_name", "[0-9].csv$", ".csv"))

    events = DL.file_events(of(good_files(spark, sf)), of(bad_files(spark, sf)))
    half = F.dayofmonth("at") % 2 == 0
    return DL.dead_letters(DL.merge(DL.fold(events.where(half)).unionByName(DL.fold(events.where(~half)))))


def q_curve_clustered_write(spark, sf):
    """The good-file mart laid out along a curve through two columns."""
    path = scratch_path(spark, "curve")
    CU.write_curve(good_files(spark, sf), path, "load_date", ["file_name", "record_count"])
    return W.read_partitioned(spark, path, {"load_date": "date"})


def q_overlapping_files(spark, sf):
    return OV.overlapping_files(OV.file_chunks(manifest(spark, sf)))


def q_dlq_summary_from_state(spark, sf):
    """The dead-letter summary from the states of two batches, the second of which numbers only new names."""
    bad = bad_files(spark, sf).withColumn("failed_timestamp", F.col("load_timestamp"))  # failures of several days
    early = bad.where(F.dayofmonth("failed_timestamp") < 28)
    late = bad.where(F.dayofmonth("failed_timestamp") >= 27)
    known = DS.number_names(early.select("file_name"))
    numbers = DS.number_names(late.select("file_name"), known)
    of_27 = F.col("day") == F.lit("2024-01-27").cast("date")
    first = DS.failure_state(early, known)
    return DS.dlq_summary(first.where(~of_27).unionByName(DS.failure_state(late, numbers)))


def q_freshness_alerts(spark, sf):
    """Alerts of each tenant's events as loads, replayed as a stream."""
    apply_base_conf(spark)
    path = scratch_path(spark, "loads")
    (A.table(spark, sf, "events").select(F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("source"),
                                         F.col("ts").cast("timestamp").alias("load_timestamp")).write.parquet(path))
    out = scratch_path(spark, "alerts")
    FR.run_alerts(spark, spark.readStream.schema("source string, load_timestamp timestamp").parquet(path), out, scratch_path(spark, "alerts-ckpt"))
    return spark.read.schema(FR.ALERT_DDL).parquet(out)


QUERIES.update({
    "freshness_alerts": q_freshness_alerts,
    "curve_clustered_write": q_curve_clustered_write,
    "overlapping_files": q_overlapping_files,
    "dlq_summary_from_state": q_dlq_summary_from_state,
    "csv_scan_split": q_csv_scan_split,
    "rejected_rows": q_rejected_rows,
    "inferred_types": q_inferred_types,
    "rolling_aggregates": q_rolling_aggregates,
    "incremental_marts": q_incremental_marts,
    "compacted_write": q_compacted_write,
    "dead_letters": q_dead_letters,
})
