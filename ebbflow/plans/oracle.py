"""DuckDB SQL that independently recomputes each registered query.

The tables ``events`` and ``documents`` are views over the same parquet files
the Spark queries read. The adapters (``ebbflow.plans.adapters``) are repeated
here in SQL, then each operator is written the plain relational way (routing
as an OR-join, coverage as a filtered cross product, dedupe as a window) so
the two sides do not share a formulation.
"""

from __future__ import annotations

import hashlib
import re

from ebbflow import config as C
from ebbflow.plans import adapters as A


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rules_cte(rules=C.DEFAULT_RULES) -> str:
    rows = []
    for s, c, v, a in rules:
        allowed = "NULL::VARCHAR[]" if a is None else "[" + ", ".join(_q(t) for t in a) + "]::VARCHAR[]"
        rows.append(f"({_q(s)}, {_q(c)}, {_q(v)}, {allowed})")
    return ("rules AS (SELECT * FROM (VALUES " + ", ".join(rows)
            + ") AS r(suffix, filter_column, filter_value, allowed))")


_TENANT_CASE = "CASE user_id % 5 " + " ".join(
    f"WHEN {k} THEN {_q(t)}" for k, t in enumerate(A.ADAPTER_TENANTS)) + " END"

EV_AS_OF = A.EVENTS_CLOCK.as_of
EV_DATE = A.EVENTS_CLOCK.as_of_date
FS_AS_OF = A.FILES_CLOCK.as_of
FS_DATE = A.FILES_CLOCK.as_of_date

RAW = f"""
ev AS (
  SELECT *,
    epoch_us(ts) // 1000000 AS sec,
    epoch_us(ts) // 1000 AS ms,
    CAST(round(value * 100) AS BIGINT) AS cents,
    CASE WHEN event_type = 'click' THEN 'ad_impression'
         WHEN event_type = 'purchase' THEN 'iap_purchased'
         WHEN event_type = 'view' THEN
           CASE WHEN event_id % 4 = 0 THEN 'level_started'
                WHEN event_id % 4 = 1 THEN 'Asset_Balance'
                WHEN event_id % 4 = 2 THEN 'asset_balance'
                WHEN event_id % 8 = 3 THEN 'game_started' END
         WHEN event_type = 'signup' THEN
           CASE WHEN event_id % 5 = 0 THEN 'earn_asset'
                WHEN event_id % 5 = 1 THEN 'ad_call' END
         ELSE 'level_finished' END AS en
  FROM events
),
raw AS (
  SELECT
    'u' || CAST(user_id AS VARCHAR) AS adid,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 101 = 0 THEN 'bad'
         WHEN event_id % 3 = 0 THEN CAST(ms AS VARCHAR)
         ELSE CAST(sec AS VARCHAR) END AS created_at,
    CASE WHEN event_id % 83 = 0 THEN NULL
         ELSE CAST(sec - (event_id % 40) * 86400 - 3600 AS VARCHAR) END AS installed_at,
    CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 10 = 0 THEN ' Session ' ELSE 'session' END
         WHEN event_type = 'signup' THEN CASE WHEN event_id % 9 = 0 THEN 'install_update' ELSE 'install' END
         WHEN event_type = 'error' THEN 'unknown'
         ELSE 'event' END AS activity_kind,
    CASE WHEN event_id % 89 = 0 THEN 'not json' ELSE
      '{{' || CASE WHEN en IS NULL THEN '' ELSE '"adjust_event_name": "' || en || '", ' END
      || '"game": "g' || CAST(user_id % 3 AS VARCHAR) || '", '
      || '"ad_format": "' || CASE WHEN event_id % 2 = 0 THEN 'banner' ELSE 'video' END || '", '
      || CASE WHEN event_id % 7 = 0 THEN '' ELSE '"ad_placement": "p' || CAST(user_id % 3 AS VARCHAR) || '", ' END
      || '"ad_revenue": "' || CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || '"}}'
    END AS publisher_parameters,
    CASE user_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' WHEN 2 THEN 'TR' END AS country,
    CASE WHEN user_id % 6 = 0 THEN 'Rio, "Lagoa"' || chr(10) || 'BR' ELSE 'city' || CAST(user_id % 6 AS VARCHAR) END AS city,
    CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS os_name,
    CASE user_id % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'tablet' END AS device_type,
    '1.' || CAST(user_id % 4 AS VARCHAR) AS app_version_short,
    CASE WHEN user_id = {A.NOMATCH_USER} THEN '{A.SOURCE_ROOT}/nomatch.csv.gz'
         ELSE '{A.SOURCE_ROOT}/' || {_TENANT_CASE} || '_' || strftime(ts, '%Y-%m-%d') || 'T00.csv.gz'
    END AS filename
  FROM ev
),
rawp AS (
  SELECT *, regexp_extract(filename, '([^/]+)_[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T', 1) AS prefix FROM raw
)"""


def _jx(key: str) -> str:
    return (f"CASE WHEN json_valid(publisher_parameters) "
            f"THEN json_extract_string(publisher_parameters, '$.{key}') END")


def _epoch_ts(col: str) -> str:
    n = f"TRY_CAST(trim({col}) AS BIGINT)"
    return (f"CASE WHEN {n} >= {C.EPOCH_MS_THRESHOLD} THEN make_timestamp({n} * 1000) "
            f"ELSE make_timestamp({n} * 1000000) END")


def processed_cte(name: str = "processed", src: str = "rawp") -> str:
    return f"""
{name} AS (
  SELECT {src}.*,
    {_jx('adjust_event_name')} AS pp_event_name,
    {_jx('game')} AS pp_game,
    {_jx('ad_format')} AS pp_ad_format,
    {_jx('ad_placement')} AS pp_ad_placement,
    {_jx('ad_revenue')} AS pp_ad_revenue,
    '{EV_AS_OF}' AS _time,
    CAST({_epoch_ts('created_at')} AS DATE) AS date
  FROM {src}
  WHERE created_at IS NOT NULL
    AND lower(trim(activity_kind)) IN ('session', 'install', 'install_update', 'event')
)"""


PROCESSED = RAW + "," + processed_cte()

def routed_cte(name: str = "routed", src: str = "processed") -> str:
    return f"""
{name} AS (
  SELECT p.*, r.suffix, p.prefix || '_' || lower(r.suffix) AS table_name
  FROM {src} p
  JOIN rules r
    ON (r.filter_column = 'activity_kind' AND p.activity_kind = r.filter_value)
    OR (r.filter_column = 'pp_event_name' AND p.pp_event_name = r.filter_value)
  WHERE p.prefix IS NOT NULL
    AND (r.allowed IS NULL OR list_contains(r.allowed, p.prefix))
)"""


ROUTED = PROCESSED + ",\n" + rules_cte() + "," + routed_cte()

KEPT = ("adid, created_at, installed_at, activity_kind, publisher_parameters, country, city, os_name, "
        "device_type, app_version_short, filename, pp_event_name, _time, date")

def adagg_cte(name: str = "adagg", src: str = "processed") -> str:
    return f"""
{name} AS (
  SELECT prefix, date, adid, country, os_name, device_type, app_version_short,
    pp_game AS game_name, pp_ad_format AS ad_format, pp_ad_placement AS ad_placement,
    COUNT(*) AS ad_count,
    round(SUM(TRY_CAST(pp_ad_revenue AS DOUBLE)), 6) AS ad_revenue,
    CAST(MAX(date_diff('day', {_epoch_ts('installed_at')}, {_epoch_ts('created_at')})) AS BIGINT) AS aging,
    '{EV_AS_OF}' AS _time
  FROM {src}
  WHERE pp_event_name = 'ad_impression' AND date >= DATE '{EV_DATE}' - {C.AD_LOOKBACK_DAYS}
  GROUP BY prefix, date, adid, country, os_name, device_type, app_version_short,
    pp_game, pp_ad_format, pp_ad_placement
)"""


AD_AGG = PROCESSED + "," + adagg_cte()

MANIFEST = f"""
manifest AS (
  SELECT
    'file_' || CAST(CASE WHEN doc_id % 100 = 1 THEN doc_id - 1 ELSE doc_id END AS VARCHAR) || '.csv' AS file_name,
    make_timestamp((({A.MANIFEST_BASE_EPOCH}) - (doc_id % 10) * 86400) * 1000000) AS load_timestamp,
    md5(text) AS file_hash,
    CAST(CASE WHEN doc_id % 199 = 0 THEN NULL
              WHEN doc_id % 211 = 0 THEN 1000001
              WHEN doc_id % 223 = 0 THEN -1
              ELSE length(text) - length(replace(text, chr(10), '')) END AS BIGINT) AS record_count,
    CASE WHEN doc_id % 53 = 0 THEN '' WHEN doc_id % 59 = 0 THEN NULL ELSE text END AS raw_content
  FROM documents
),
staged AS (
  SELECT file_name, load_timestamp, file_hash, record_count, raw_content,
    CAST(length(raw_content) AS BIGINT) AS content_length,
    TIMESTAMP '{FS_AS_OF}' AS processed_at,
    CASE WHEN raw_content IS NULL THEN false WHEN length(raw_content) = 0 THEN false ELSE true END
      AS is_valid_content
  FROM manifest
  WHERE load_timestamp >= CAST(DATE '{FS_DATE}' - {C.RETENTION_DAYS} AS TIMESTAMP)
),
validated AS (
  SELECT file_name, load_timestamp, file_hash, record_count,
    CASE WHEN is_valid_content = true AND record_count > 0 AND record_count <= {C.MAX_RECORDS_PER_FILE}
         THEN true ELSE false END AS is_valid_file,
    CASE WHEN is_valid_content = false THEN 'INVALID_CONTENT'
         WHEN record_count = 0 THEN 'EMPTY_FILE'
         WHEN record_count > {C.MAX_RECORDS_PER_FILE} THEN 'FILE_TOO_LARGE' END AS validation_error,
    TIMESTAMP '{FS_AS_OF}' AS validation_timestamp
  FROM staged
),
validated2 AS (
  SELECT *, CASE WHEN is_valid_file THEN 'READY_FOR_PROCESSING' ELSE 'FAILED_VALIDATION' END
    AS processing_status
  FROM validated
),
pfiles AS (
  SELECT file_name, load_timestamp, CAST(load_timestamp AS DATE) AS load_date, file_hash, record_count,
    processing_status, TIMESTAMP '{FS_AS_OF}' AS inserted_at, TIMESTAMP '{FS_AS_OF}' AS updated_at
  FROM validated2
  WHERE is_valid_file = true AND processing_status = 'READY_FOR_PROCESSING'
),
ffiles AS (
  SELECT file_name, load_timestamp, CAST(validation_timestamp AS DATE) AS failure_date, file_hash,
    record_count, validation_error AS failure_reason, processing_status,
    validation_timestamp AS failed_timestamp,
    concat('{A.DLQ_LOCATION}', '/', strftime(validation_timestamp, '%Y/%m/%d'), '/', file_name)
      AS file_location_dlq,
    TIMESTAMP '{FS_AS_OF}' AS dlq_inserted_at,
    false AS is_resolved
  FROM validated2
  WHERE is_valid_file = false OR processing_status = 'FAILED_VALIDATION'
)"""


def _contract_sql(src: str, present: list[str]) -> str:
    """Schema-contract rows (one per declared column) over the CTE ``src``."""
    rows = []
    for c in C.REQUIRED_COLUMNS:
        etype = "epoch" if c in C.TIMESTAMP_COLUMNS else "string"
        if c in present:
            bad = (f"(SELECT COUNT(*) FROM {src} WHERE {c} IS NOT NULL AND TRY_CAST(trim({c}) AS BIGINT) IS NULL)"
                   if c in C.TIMESTAMP_COLUMNS else "0")
            rows.append(f"SELECT '{c}' AS column_name, '{etype}' AS expected_type, true AS is_present, "
                        f"CAST((SELECT COUNT(*) FROM {src} WHERE {c} IS NULL) AS BIGINT) AS null_count, "
                        f"CAST({bad} AS BIGINT) AS cast_failures")
        else:
            rows.append(f"SELECT '{c}' AS column_name, '{etype}' AS expected_type, false AS is_present, "
                        f"CAST(NULL AS BIGINT) AS null_count, CAST(NULL AS BIGINT) AS cast_failures")
    return "\nUNION ALL\n".join(rows)


def _with(ctes: str, body: str) -> str:
    """``WITH <ctes> <body>``; a body starting with ``,`` adds more CTEs first."""
    return "WITH " + ctes.strip() + ("" if body.startswith(",") else "\n") + body


def _rate(ok: str, bad: str) -> str:
    return (f"CASE WHEN ({ok} + {bad}) > 0 THEN round(CAST(100.0 * {ok} AS DOUBLE) / ({ok} + {bad}), 2) "
            f"ELSE 0.0 END")


def _bucket(col: str, thresholds, default: str, op: str) -> str:
    parts = " ".join(f"WHEN {col} {op} {b} THEN '{label}'" for b, label in thresholds)
    return f"CASE {parts} ELSE '{default}' END"


DAILY_BY_LOAD_DATE = MANIFEST + """,
daily AS (
  SELECT d AS load_date, SUM(ok) AS ok, SUM(bad) AS bad FROM (
    SELECT CAST(load_timestamp AS DATE) AS d, 1 AS ok, 0 AS bad FROM pfiles
    UNION ALL
    SELECT CAST(load_timestamp AS DATE) AS d, 0 AS ok, 1 AS bad FROM ffiles
  ) GROUP BY d
)"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["json_params"] = _with(RAW, f"""
SELECT adid, created_at, publisher_parameters,
  {_jx('adjust_event_name')} AS pp_event_name, {_jx('game')} AS pp_game,
  {_jx('ad_format')} AS pp_ad_format, {_jx('ad_placement')} AS pp_ad_placement,
  {_jx('ad_revenue')} AS pp_ad_revenue
FROM raw""")
    q["epoch_to_date"] = _with(RAW, f"""
SELECT adid, created_at, epoch_us({_epoch_ts('created_at')}) // 1000000 AS created_epoch_s,
  CAST({_epoch_ts('created_at')} AS DATE) AS date
FROM raw""")
    q["install_age_days"] = _with(PROCESSED, f"""
SELECT adid, created_at, installed_at,
  CAST(date_diff('day', {_epoch_ts('installed_at')}, {_epoch_ts('created_at')}) AS BIGINT) AS aging
FROM processed""")
    q["filter_activity"] = _with(PROCESSED, "SELECT * FROM processed")
    q["tenant_from_path"] = _with(RAW, "SELECT DISTINCT filename, prefix FROM rawp")
    q["distinct_tenants"] = _with(PROCESSED, "SELECT DISTINCT prefix FROM processed WHERE prefix IS NOT NULL")
    q["exclude_columns"] = _with(PROCESSED, f"SELECT {KEPT} FROM processed")
    q["route_events"] = _with(ROUTED, f"SELECT {KEPT}, table_name FROM routed")
    q["routing_coverage"] = _with(ROUTED, """,
tenants AS (SELECT DISTINCT prefix FROM processed WHERE prefix IS NOT NULL),
pairs AS (
  SELECT t.prefix, r.suffix FROM tenants t CROSS JOIN rules r
  WHERE r.allowed IS NULL OR list_contains(r.allowed, t.prefix)
),
counts AS (SELECT prefix, suffix, COUNT(*) AS n FROM routed GROUP BY prefix, suffix)
SELECT pairs.prefix, pairs.suffix, pairs.prefix || '_' || lower(pairs.suffix) AS table_name,
  CAST(COALESCE(counts.n, 0) AS BIGINT) AS routed_rows,
  CASE WHEN COALESCE(counts.n, 0) > 0 THEN 'written' ELSE 'empty' END AS status
FROM pairs LEFT JOIN counts ON pairs.prefix = counts.prefix AND pairs.suffix = counts.suffix""")
    q["ad_preagg"] = _with(AD_AGG, "SELECT * FROM adagg")
    q["ad_preagg_output"] = _with(AD_AGG, f"""
SELECT prefix || '_{C.AD_AGG_TABLE_SUFFIX}' AS table_name, date, adid AS user_id, country, os_name,
  device_type, app_version_short, game_name, ad_format, ad_placement,
  CAST(NULL AS VARCHAR) AS iap_product_id, ad_count, ad_revenue,
  CAST(0 AS BIGINT) AS iap_count, CAST(0.0 AS DOUBLE) AS iap_revenue, CAST(0 AS BIGINT) AS session_count,
  aging, _time
FROM adagg WHERE prefix IS NOT NULL""")
    q["dq_raw_events"] = _with(RAW, """
SELECT adid, created_at, activity_kind, filename,
  CASE WHEN created_at IS NULL THEN 'created_at_is_null'
       WHEN NOT COALESCE(lower(trim(activity_kind)) IN ('session', 'install', 'install_update', 'event'), false)
       THEN 'activity_kind_not_accepted' END AS violation
FROM raw
WHERE created_at IS NULL
   OR NOT COALESCE(lower(trim(activity_kind)) IN ('session', 'install', 'install_update', 'event'), false)""")
    present = ["adid", "created_at", "installed_at", "activity_kind", "publisher_parameters", "city",
               "country", "os_name", "device_type", "app_version_short"]
    q["dq_schema_contract"] = _with(RAW, _contract_sql("raw", present))

    # ---- file governance over the documents-derived manifest ----
    q["stg_raw_files"] = _with(MANIFEST, "SELECT * FROM staged")
    q["validate_files"] = _with(MANIFEST, "SELECT * FROM validated2")
    q["processed_files"] = _with(MANIFEST, "SELECT * FROM pfiles")
    q["failed_files"] = _with(MANIFEST, "SELECT * FROM ffiles")
    q["dlq_path"] = _with(MANIFEST, f"""
SELECT file_name,
  concat('{A.DLQ_LOCATION}', '/', file_name) AS dlq_flat,
  concat('{A.DLQ_LOCATION}', '/', strftime(failed_timestamp, '%Y/%m/%d'), '/', file_name) AS dlq_day,
  concat('{A.DLQ_LOCATION}', '/', strftime(failed_timestamp, '%Y/%m/%d/%H'), '/', file_name) AS dlq_hour
FROM ffiles""")
    q["content_checks"] = _with(MANIFEST, f"""
SELECT file_name, (n_errors = 0) AS is_valid, n_errors, error_list, warning_list FROM (
  SELECT file_name,
    CAST((CASE WHEN raw_content IS NULL OR raw_content = '' THEN 1 ELSE 0 END)
       + (CASE WHEN raw_content IS NOT NULL AND strpos(raw_content, ',') = 0 THEN 1 ELSE 0 END)
       + (CASE WHEN file_name IS NULL OR file_name = '' THEN 1 ELSE 0 END) AS INTEGER) AS n_errors,
    concat_ws('|',
      CASE WHEN raw_content IS NULL OR raw_content = '' THEN '{C.CONTENT_ERROR_EMPTY}' END,
      CASE WHEN raw_content IS NOT NULL AND strpos(raw_content, ',') = 0 THEN '{C.CONTENT_ERROR_NO_COMMA}' END,
      CASE WHEN file_name IS NULL OR file_name = '' THEN '{C.CONTENT_ERROR_NO_NAME}' END) AS error_list,
    concat_ws('|', CASE WHEN length(raw_content) > {C.CONTENT_WARN_CHARS}
      THEN '{C.CONTENT_WARNING_SIZE.format(max_size=C.CONTENT_WARN_CHARS)}' END) AS warning_list
  FROM manifest)""")
    nn = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count FROM pfiles"
        for c in ["file_name", "load_timestamp", "load_date", "file_hash", "record_count",
                  "processing_status", "inserted_at", "updated_at"])
    q["dq_not_null"] = _with(MANIFEST, nn)
    q["dq_unique"] = _with(MANIFEST, """
SELECT file_name AS unique_field, COUNT(*) AS n_records FROM pfiles
WHERE file_name IS NOT NULL GROUP BY file_name HAVING COUNT(*) > 1""")
    q["dq_accepted_values"] = _with(MANIFEST, """
SELECT processing_status AS value_field, COUNT(*) AS n_records FROM validated2
WHERE processing_status IS NOT NULL AND processing_status NOT IN ('READY_FOR_PROCESSING')
GROUP BY processing_status""")
    q["dq_positive"] = _with(MANIFEST, "SELECT * FROM validated2 WHERE record_count <= 0 OR record_count IS NULL")
    q["dq_no_duplicates"] = _with(MANIFEST, """
SELECT file_name, COUNT(*) AS occurrence_count FROM pfiles GROUP BY file_name HAVING COUNT(*) > 1""")
    nn_rows = "\nUNION ALL\n".join(
        f"SELECT 'not_null' AS check_name, '{c}' AS column_name, "
        f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM pfiles"
        for c in ["file_name", "load_timestamp", "load_date", "file_hash", "record_count",
                  "processing_status", "inserted_at", "updated_at"])
    q["dq_checks"] = _with(MANIFEST, f""",
c AS (
{nn_rows}
UNION ALL
SELECT 'unique', 'file_name', CAST(COUNT(*) AS BIGINT) FROM (
  SELECT file_name FROM pfiles WHERE file_name IS NOT NULL GROUP BY file_name HAVING COUNT(*) > 1)
UNION ALL
SELECT 'accepted_values', 'processing_status', CAST(COUNT(*) AS BIGINT) FROM pfiles
  WHERE processing_status IS NOT NULL AND processing_status NOT IN ('READY_FOR_PROCESSING')
UNION ALL
SELECT 'assert_greater_than_zero', 'record_count', CAST(COUNT(*) AS BIGINT) FROM pfiles
  WHERE record_count <= 0 OR record_count IS NULL
UNION ALL
SELECT 'no_duplicate_files', 'file_name', CAST(COUNT(*) AS BIGINT) FROM (
  SELECT file_name FROM pfiles GROUP BY file_name HAVING COUNT(*) > 1)
)
SELECT check_name, column_name, violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status
FROM c""")
    q["dq_freshness"] = _with(MANIFEST, f"""
SELECT max_loaded_at, TIMESTAMP '{FS_AS_OF}' AS snapshotted_at, age_seconds,
  CASE WHEN max_loaded_at IS NULL THEN 'error'
       WHEN age_seconds > {C.FRESHNESS_ERROR_HOURS * 3600} THEN 'error'
       WHEN age_seconds > {C.FRESHNESS_WARN_HOURS * 3600} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max_loaded_at,
        CAST(epoch(TIMESTAMP '{FS_AS_OF}') - epoch(max_loaded_at) AS BIGINT) AS age_seconds
      FROM (SELECT MAX(load_timestamp) AS max_loaded_at FROM pfiles))""")
    q["processing_stats"] = _with(MANIFEST, f""",
p AS (SELECT load_date, COUNT(*) AS total_files, SUM(record_count) AS total_records FROM pfiles GROUP BY load_date),
f AS (SELECT CAST(failed_timestamp AS DATE) AS fdate, COUNT(*) AS failed_files,
        COUNT(DISTINCT failure_reason) AS distinct_failures FROM ffiles GROUP BY CAST(failed_timestamp AS DATE)),
c AS (
  SELECT COALESCE(p.load_date, f.fdate) AS date,
    CAST(COALESCE(p.total_files, 0) AS BIGINT) AS successful_files,
    CAST(COALESCE(f.failed_files, 0) AS BIGINT) AS failed_files,
    CAST(COALESCE(p.total_records, 0) AS BIGINT) AS total_records,
    CAST(COALESCE(f.distinct_failures, 0) AS BIGINT) AS distinct_failure_types
  FROM p FULL OUTER JOIN f ON p.load_date = f.fdate
),
r AS (SELECT *, {_rate('successful_files', 'failed_files')} AS success_rate FROM c)
SELECT date, successful_files, failed_files, successful_files + failed_files AS total_files,
  total_records, distinct_failure_types, success_rate,
  {_bucket('success_rate', C.RATING_THRESHOLDS, C.RATING_DEFAULT, '>=')} AS quality_rating
FROM r ORDER BY date DESC""")
    q["dlq_summary"] = _with(MANIFEST, f""",
d AS (
  SELECT failure_reason, COUNT(*) AS failure_count, COUNT(DISTINCT file_name) AS distinct_files,
    MIN(failed_timestamp) AS first_failure, MAX(failed_timestamp) AS last_failure,
    AVG(record_count) AS avg_record_count
  FROM ffiles WHERE is_resolved = false GROUP BY failure_reason
)
SELECT failure_reason, failure_count, distinct_files, first_failure, last_failure, avg_record_count,
  {_bucket('failure_count', C.SEVERITY_THRESHOLDS, C.SEVERITY_DEFAULT, '>')} AS severity
FROM d ORDER BY failure_count DESC""")
    q["dlq_unresolved"] = _with(MANIFEST, "SELECT * FROM ffiles WHERE is_resolved = false")
    q["severity_buckets"] = _with(MANIFEST, f"""
SELECT load_date, failure_reason, failure_count,
  {_bucket('failure_count', C.SEVERITY_THRESHOLDS, C.SEVERITY_DEFAULT, '>')} AS severity
FROM (SELECT CAST(load_timestamp AS DATE) AS load_date, failure_reason, COUNT(*) AS failure_count
      FROM ffiles GROUP BY CAST(load_timestamp AS DATE), failure_reason)""")
    q["success_rate"] = _with(DAILY_BY_LOAD_DATE, f"""
SELECT load_date, CAST(ok AS BIGINT) AS successful_files, CAST(bad AS BIGINT) AS failed_files,
  {_rate('ok', 'bad')} AS success_rate
FROM daily""")
    q["quality_rating"] = _with(DAILY_BY_LOAD_DATE, f"""
SELECT load_date, success_rate,
  {_bucket('success_rate', C.RATING_THRESHOLDS, C.RATING_DEFAULT, '>=')} AS quality_rating
FROM (SELECT load_date, {_rate('ok', 'bad')} AS success_rate FROM daily)""")
    q["read_stats"] = _with(MANIFEST, """
SELECT COUNT(DISTINCT file_name) AS files_read,
  CAST(COALESCE(SUM(record_count), 0) AS BIGINT) AS total_records,
  CAST(COALESCE(SUM(content_length), 0) AS BIGINT) AS total_size,
  round(CAST(COALESCE(SUM(content_length), 0) AS DOUBLE) / (1024.0 * 1024.0), 2) AS total_size_mb
FROM staged""")
    q["write_stats"] = _with(MANIFEST, """
SELECT COUNT(*) AS rows_written, CAST(COALESCE(SUM(record_count), 0) AS BIGINT) AS total_records FROM pfiles""")
    q["run_manifest"] = _with(MANIFEST, f"""
SELECT file_name, file_hash, 'processed' AS outcome, CAST(NULL AS VARCHAR) AS failure_reason,
  TIMESTAMP '{FS_AS_OF}' AS generated_at, 'development' AS environment FROM pfiles
UNION ALL
SELECT file_name, file_hash, 'failed' AS outcome, failure_reason,
  TIMESTAMP '{FS_AS_OF}' AS generated_at, 'development' AS environment FROM ffiles""")
    q["dedupe_latest"] = _with(MANIFEST, """
SELECT file_name, load_timestamp, file_hash, record_count, raw_content FROM (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY load_timestamp DESC, file_hash DESC) AS rn
  FROM manifest) WHERE rn = 1""")
    return q


# ------------------------------------------------- file sources (round trip)
from ebbflow.plans import exports as XP  # noqa: E402

_BROKEN = list(XP.BROKEN_FILES.items())
_GZ_LIST = ", ".join(_q(t) for t in XP.GZIP_TENANTS)
_TENANT_OF = {name: name.split("_")[0] for name, _ in _BROKEN}

EXPORTS = RAW + f""",
exp AS (
  SELECT rawp.*, regexp_extract(filename, '[^/]+$', 0) AS file_name,
    COALESCE(TRY_CAST(regexp_extract(filename, '_[0-9]{{4}}-[0-9]{{2}}-([0-9]{{2}})T', 1) AS INTEGER), 0) AS day,
    COALESCE(created_at LIKE '%{XP.MALFORMED_SUFFIX}', false) AS is_malformed
  FROM rawp
),
scanned AS (
  SELECT adid, created_at, installed_at, activity_kind, publisher_parameters, country, city, os_name,
    CASE WHEN day % 2 = 0 THEN device_type END AS device_type, app_version_short,
    CASE WHEN day % 2 = 1 THEN 'x' END AS extra, file_name, prefix
  FROM exp WHERE NOT is_malformed
),
cut AS (
  SELECT DISTINCT replace(file_name, '{XP.GZIP_TENANTS[0]}_', '{XP.GZIP_TENANTS[0]}-cut_') AS file_name,
    '{XP.GZIP_TENANTS[0]}-cut' AS prefix
  FROM exp WHERE prefix = '{XP.GZIP_TENANTS[0]}' AND day % 7 = 3
)"""


def _broken_values(cols: str, row) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(row(n, b, st) for n, (b, st) in _BROKEN) + f") AS t({cols})"


def file_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["discover_files"] = _with(EXPORTS, "SELECT DISTINCT file_name, prefix, false AS is_empty FROM exp\nUNION ALL\n"
                                "SELECT file_name, prefix, false AS is_empty FROM cut\nUNION ALL\n"
                                + _broken_values("file_name, prefix, is_empty", lambda n, b, st:
                                                 f"({_q(n)}, {_q(_TENANT_OF[n])}, {'true' if not b else 'false'})"))
    q["csv_scan"] = _with(EXPORTS, "SELECT * FROM scanned")
    q["union_by_name"] = _with(EXPORTS, """
SELECT file_name, COUNT(*) AS n_rows, COUNT(device_type) AS with_device_type, COUNT(extra) AS with_extra
FROM scanned GROUP BY file_name""")
    q["malformed_rows"] = _with(EXPORTS, """
SELECT file_name, COUNT(*) AS malformed_rows FROM exp WHERE is_malformed GROUP BY file_name""")
    q["misnamed_gz_scan"] = _with(EXPORTS, f"""
SELECT file_name, COUNT(*) AS n_rows, any_value(prefix IN ({_GZ_LIST})) AS is_gzip FROM scanned GROUP BY file_name""")
    q["file_provenance"] = _with(EXPORTS, """
SELECT file_name, prefix, COUNT(*) AS n_rows FROM scanned GROUP BY file_name, prefix""")
    cols = ["adid", "created_at", "installed_at", "activity_kind", "publisher_parameters", "country", "city",
            "os_name", "device_type", "app_version_short", "extra"]
    q["normalize_columns"] = _with(EXPORTS, "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS non_null_values FROM scanned" for c in cols))
    present = ["adid", "created_at", "installed_at", "activity_kind", "publisher_parameters", "country", "city",
               "os_name", "device_type", "app_version_short"]
    q["dq_schema_contract_files"] = _with(EXPORTS, _contract_sql("scanned", present))
    status_rows = _broken_values("file_name, status, is_gzip", lambda n, b, st: (
        f"({_q(n)}, {_q(st)}, " + ("NULL" if not b else ("true" if b[:2] == b'\x1f\x8b' else "false")) + ")"))
    q["file_isolation"] = _with(EXPORTS, f"""
SELECT DISTINCT file_name, 'OK' AS status, prefix IN ({_GZ_LIST}) AS is_gzip FROM exp
UNION ALL
SELECT file_name, 'CORRUPT_GZIP' AS status, true AS is_gzip FROM cut
UNION ALL
{status_rows}""")
    failed = [(n, b, st) for n, (b, st) in _BROKEN if st != "OK"]
    q["quarantine_files"] = _with(EXPORTS, f"""
SELECT file_name, {_q(A.DLQ_LOCATION + '/')} || file_name AS dlq_path, 'CORRUPT_GZIP' AS reason,
  CAST({XP.CUT_BYTES} AS BIGINT) AS length, CAST({XP.CUT_BYTES} AS BIGINT) AS content_bytes FROM cut
UNION ALL
SELECT * FROM (VALUES """ + ", ".join(
        f"({_q(n)}, {_q(A.DLQ_LOCATION + '/' + n)}, {_q(st)}, CAST({len(b)} AS BIGINT), CAST({len(b)} AS BIGINT))"
        for n, b, st in failed) + ") AS t(file_name, dlq_path, reason, length, content_bytes)")
    from ebbflow.plans.catalog import WINDOW_DATE, WINDOW_TENANTS
    q["source_window"] = _with(EXPORTS, f"""
SELECT adid, created_at, activity_kind, file_name, prefix FROM scanned
WHERE file_name LIKE '%\\_{WINDOW_DATE}T%' ESCAPE '\\' AND prefix IN ({", ".join(_q(t) for t in WINDOW_TENANTS)})""")
    q["empty_input"] = _with(EXPORTS + "," + processed_cte("sp", "scanned"), f"""
SELECT 'none' AS "window", CAST(0 AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_tenants
UNION ALL
SELECT 'day', COUNT(*), COUNT(DISTINCT prefix) FROM sp WHERE file_name LIKE '%\\_{WINDOW_DATE}T%' ESCAPE '\\'
UNION ALL
SELECT 'all', COUNT(*), COUNT(DISTINCT prefix) FROM sp""")
    def digests(n: str, b: bytes, st: str) -> str:
        own = _q(hashlib.sha256(b).hexdigest())
        return (own if b and _TENANT_OF[n] not in XP.GZIP_TENANTS else "NULL") + ", " + (own if st == "OK" else "NULL")

    manifest_rows = _broken_values("file_name, record_count, has_hash, plain_hash, content_sha256, content_chars, content_lines", lambda n, b, st: (
        f"({_q(n)}, " + ("CAST(0 AS BIGINT)" if st == "OK" else "CAST(NULL AS BIGINT)") + ", "
        + ("true" if b else "false") + ", " + digests(n, b, st) + ", " + (f"CAST({len(b)} AS BIGINT), CAST({b.count(10)} AS BIGINT)" if st == "OK" and b else
                                               "CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)") + ")"))

    def line(layout: list[str], chars: str) -> str:
        """Characters (or line ends) of a record: quoted fields with doubled quotes, commas between, a line end."""
        def field(c: str) -> str:
            n = c.strip("{}")
            if n == "extra":
                return "3" if chars == "chars" else "0"
            v = f"replace({n}, '\"', '\"\"')"
            return (f"COALESCE(length({v}) + 2, 0)" if chars == "chars"
                    else f"COALESCE(length({n}) - length(replace({n}, chr(10), '')), 0)")
        short = " + ".join(field(c) for c in layout[:-1])
        sep = len(layout) - 2 if chars == "chars" else 0
        last = field(layout[-1]) + (" + 1" if chars == "chars" else "")
        return f"{short} + {sep} + 1 + CASE WHEN is_malformed THEN 0 ELSE {last} END"

    def total(chars: str) -> str:
        a, b = line(XP.LAYOUT_A, chars), line(XP.LAYOUT_B, chars)
        ha, hb = ((len(",".join(x)) + 1) if chars == "chars" else 1 for x in (XP.LAYOUT_A, XP.LAYOUT_B))
        return (f"CAST(SUM(CASE WHEN day % 2 = 0 THEN {a} ELSE {b} END) + "
                f"any_value(CASE WHEN day % 2 = 0 THEN {ha} ELSE {hb} END) AS BIGINT)")

    def record(layout: list[str]) -> str:
        """A record's text."""
        def field(c: str) -> str:
            n = c.strip("{}")
            return "'\"x\"'" if n == "extra" else f"COALESCE('\"' || replace({n}, '\"', '\"\"') || '\"', '')"
        return " || ',' || ".join(map(field, layout[:-1])) + f" || CASE WHEN is_malformed THEN '' ELSE ',' || {field(layout[-1])} END"

    heads = f"CASE WHEN day % 2 = 0 THEN {_q(','.join(XP.LAYOUT_A))} ELSE {_q(','.join(XP.LAYOUT_B))} END"
    q["file_manifest"] = _with(EXPORTS, f""",
texts AS (
  SELECT *, CASE WHEN day % 2 = 0 THEN {record(XP.LAYOUT_A)} ELSE {record(XP.LAYOUT_B)} END AS line, {heads} AS head FROM exp
),
whole AS (
  SELECT file_name, any_value(prefix) AS prefix, CAST(COUNT(*) AS BIGINT) AS record_count,
    sha256(any_value(head) || chr(10) || string_agg(line, chr(10) ORDER BY line) || chr(10)) AS digest,
    {total("chars")} AS content_chars, {total("lines")} AS content_lines
  FROM texts GROUP BY file_name
)
SELECT file_name, record_count, true AS has_hash, CASE WHEN prefix NOT IN ({_GZ_LIST}) THEN digest END AS plain_hash,
  digest AS content_sha256, content_chars, content_lines
FROM whole
UNION ALL
SELECT file_name, CAST(NULL AS BIGINT), true, NULL, NULL, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM cut
UNION ALL
{manifest_rows}""")

    def _gov(n, b, st):
        reason = "INVALID_CONTENT" if st != "OK" else "EMPTY_FILE"
        return f"({_q(n)}, 'failed', {_q(reason)})"
    q["governance_run"] = _with(EXPORTS, "SELECT DISTINCT file_name, 'processed' AS outcome, "
                                "CAST(NULL AS VARCHAR) AS failure_reason FROM exp\nUNION ALL\n"
                                "SELECT file_name, 'failed', 'INVALID_CONTENT' FROM cut\nUNION ALL\n"
                                + _broken_values("file_name, outcome, failure_reason", _gov))
    q["incremental_ingest"] = _with(EXPORTS + "," + processed_cte("sp", "scanned"), """
SELECT file_name, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS second_run_batches FROM sp GROUP BY file_name""")
    q["incremental_routed"] = _with(
        EXPORTS + "," + processed_cte("sp", "scanned") + ",\n" + rules_cte() + "," + routed_cte("sr", "sp"),
        "SELECT _time, activity_kind, adid, app_version_short, city, country, created_at, date, device_type, extra, file_name, "
        "installed_at, os_name, pp_event_name, publisher_parameters, table_name FROM sr")
    base = sql()
    q["incremental_aggregates"] = _with(
        EXPORTS + "," + processed_cte("sp", "scanned") + "," + adagg_cte("adagg", "sp"), base["ad_preagg_output"].split("SELECT prefix ||", 1)[1].join(["SELECT prefix ||", ""]))
    q["route_rules_table"] = base["route_events"]
    q["no_tenant"] = _with(PROCESSED, """
SELECT adid, created_at, activity_kind, filename, 'NO_TENANT' AS reason, CAST(0 AS BIGINT) AS n_routed
FROM processed WHERE prefix IS NULL OR prefix = ''""")
    q["partitioned_write"] = base["route_events"]
    q["agg_write"] = base["ad_preagg_output"]
    q["clustered_write"] = base["processed_files"]
    lake = (EXPORTS + "," + processed_cte("lp", "scanned") + ",\n" + rules_cte() + ","
            + routed_cte("lr", "lp") + "," + adagg_cte("la", "lp"))
    q["run_metrics"] = _with(lake, f""",
tenants AS (SELECT DISTINCT prefix FROM lp WHERE prefix IS NOT NULL),
pairs AS (SELECT t.prefix, r.suffix FROM tenants t CROSS JOIN rules r
          WHERE r.allowed IS NULL OR list_contains(r.allowed, t.prefix)),
counts AS (SELECT prefix, suffix, COUNT(*) AS n FROM lr GROUP BY prefix, suffix),
cov AS (SELECT COALESCE(counts.n, 0) AS n FROM pairs LEFT JOIN counts
        ON pairs.prefix = counts.prefix AND pairs.suffix = counts.suffix)
SELECT
  CAST((SELECT COUNT(DISTINCT file_name) FROM exp) + (SELECT COUNT(*) FROM cut) + {len(_BROKEN)} AS BIGINT) AS files_total,
  CAST((SELECT COUNT(DISTINCT file_name) FROM exp) + {sum(1 for _, (_, st) in _BROKEN if st == 'OK')} AS BIGINT) AS files_ok,
  CAST((SELECT COUNT(*) FROM cut) + {sum(1 for _, (_, st) in _BROKEN if st != 'OK')} AS BIGINT) AS files_failed,
  CAST((SELECT COUNT(*) FROM scanned) AS BIGINT) AS rows_read,
  CAST((SELECT COUNT(*) FROM exp WHERE is_malformed) AS BIGINT) AS rows_malformed,
  CAST((SELECT COUNT(*) FROM lp WHERE date IS NULL OR NOT json_valid(publisher_parameters)) AS BIGINT) AS rows_rejected,
  CAST((SELECT COUNT(*) FROM lr) AS BIGINT) AS partitioned_rows_written,
  CAST((SELECT COUNT(*) FROM lp WHERE prefix IS NOT NULL AND NOT EXISTS (
     SELECT 1 FROM rules r
     WHERE ((r.filter_column = 'activity_kind' AND lp.activity_kind = r.filter_value)
         OR (r.filter_column = 'pp_event_name' AND lp.pp_event_name = r.filter_value))
       AND (r.allowed IS NULL OR list_contains(r.allowed, lp.prefix)))) AS BIGINT) AS rows_unrouted,
  CAST((SELECT COUNT(*) FROM la WHERE prefix IS NOT NULL) AS BIGINT) AS aggregate_rows_written,
  CAST((SELECT COUNT(*) FROM cov WHERE n > 0) AS BIGINT) AS tables_written,
  CAST((SELECT COUNT(*) FROM cov WHERE n = 0) AS BIGINT) AS empty_tables,
  CAST(0 AS BIGINT) AS failed_tables, CAST(0 AS BIGINT) AS n_failed_writes""")
    q.update(run_sql(base))
    return q


def run_sql(base: dict[str, str]) -> dict[str, str]:
    """Tables kept up by runs, types and rejected rows."""
    from ebbflow.operators.types import GRAMMARS
    from ebbflow.plans.catalog import MARTS_FIRST_CLOCK, ROLLING_FIRST_CLOCK

    q = {"csv_scan_split": _with(EXPORTS, "SELECT * FROM scanned"), "compacted_write": base["route_events"]}
    q["rejected_rows"] = _with(PROCESSED, """
SELECT adid, created_at, publisher_parameters, filename,
  CASE WHEN date IS NULL THEN 'BAD_CREATED_AT' ELSE 'BAD_JSON' END AS reject_reason
FROM processed WHERE date IS NULL OR NOT json_valid(publisher_parameters)""")

    def inferred(c: str) -> str:
        whens = []
        for name, grammar in GRAMMARS:
            fits = f"regexp_matches({c}, {_q(grammar)})"
            if name in ("date", "timestamp"):
                fits += f" AND TRY_CAST(substr({c}, 1, 10) AS DATE) IS NOT NULL"
            whens.append(f"WHEN bool_and({fits}) FILTER ({c} IS NOT NULL AND {c} <> '') THEN '{name}'")
        return (f"SELECT '{c}' AS column_name, CASE {' '.join(whens)} ELSE 'string' END AS inferred_type, "
                f"COUNT(*) FILTER ({c} IS NOT NULL AND {c} <> '') AS non_empty_values FROM scanned")

    cols = ["adid", "created_at", "installed_at", "activity_kind", "publisher_parameters", "country", "city", "os_name",
            "device_type", "app_version_short", "extra"]
    q["inferred_types"] = _with(EXPORTS, "\nUNION ALL\n".join(map(inferred, cols)))
    first = "date < DATE '2024-01-21' AND right(created_at, 1) IN ('0', '2', '4', '6', '8')"
    rolling = adagg_cte().replace(f"'{EV_AS_OF}' AS _time",
                                  f"MAX(CASE WHEN {first} THEN '{ROLLING_FIRST_CLOCK.as_of}' ELSE '{EV_AS_OF}' END) AS _time")
    q["rolling_aggregates"] = _with(PROCESSED + "," + rolling, "SELECT * FROM adagg")

    earlier = MANIFEST.replace(FS_AS_OF, MARTS_FIRST_CLOCK.as_of).replace(FS_DATE, MARTS_FIRST_CLOCK.as_of_date)
    for name in ("manifest", "staged", "validated", "validated2", "pfiles", "ffiles"):
        earlier = re.sub(rf"\b{name}\b", f"{name}_1", earlier)
    earlier = earlier.replace("  FROM manifest_1\n", f"""  FROM (SELECT * REPLACE (CASE WHEN record_count % 10 = 3 THEN record_count - 1 ELSE record_count END AS record_count)
        FROM manifest_1 WHERE load_timestamp <= TIMESTAMP '{MARTS_FIRST_CLOCK.as_of}')
""")
    q["incremental_marts"] = _with(MANIFEST + "," + earlier, """
SELECT n.file_name, n.load_timestamp, n.load_date, n.file_hash, n.record_count, n.processing_status,
  COALESCE(o.inserted_at, n.inserted_at) AS inserted_at,
  CASE WHEN o.record_count = n.record_count THEN o.updated_at ELSE n.updated_at END AS updated_at
FROM pfiles n LEFT JOIN pfiles_1 o USING (file_name, file_hash)
UNION ALL
SELECT o.* FROM pfiles_1 o ANTI JOIN pfiles n USING (file_name, file_hash)""")
    q["freshness_alerts"] = f"""
WITH loads AS (SELECT DISTINCT 't' || CAST(user_id % 5 AS VARCHAR) AS source, epoch_us(ts) // 1000 AS ms FROM events WHERE ts IS NOT NULL),
gaps AS (SELECT source, ms, COALESCE(lead(ms) OVER (PARTITION BY source ORDER BY ms), (SELECT max(ms) - 1 FROM loads)) - ms AS gap FROM loads)
SELECT source, CAST(ms AS BIGINT) AS last_loaded_ms, 'warn' AS status FROM gaps WHERE gap > {C.FRESHNESS_WARN_HOURS * 3600000}
UNION ALL
SELECT source, CAST(ms AS BIGINT), 'error' FROM gaps WHERE gap > {C.FRESHNESS_ERROR_HOURS * 3600000}"""
    q["curve_clustered_write"] = base["processed_files"]
    q["overlapping_files"] = _with(MANIFEST, """,
files AS (SELECT row_number() OVER () AS f, file_name, load_timestamp, string_split(raw_content, chr(10)) AS ls FROM manifest WHERE raw_content <> ''),
lines AS (SELECT f, file_name, load_timestamp, i, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM files)),
cut AS (
  SELECT *, COALESCE(SUM(CASE WHEN CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) % 4 = 0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY f ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM lines
),
texts AS (SELECT f, any_value(file_name) AS file_name, any_value(load_timestamp) AS load_timestamp, string_agg(line, chr(10) ORDER BY i) AS text
          FROM cut GROUP BY f, chunk),
chunks AS (SELECT file_name, load_timestamp, md5(text) AS digest, length(text) AS n_chars FROM texts WHERE text <> ''),
owners AS (SELECT digest, first(file_name ORDER BY load_timestamp, file_name) AS earlier_file FROM chunks GROUP BY digest),
sizes AS (SELECT file_name, COUNT(*) AS file_chunks FROM chunks GROUP BY file_name)
SELECT file_name, earlier_file, COUNT(*) AS shared_chunks, CAST(SUM(n_chars) AS BIGINT) AS shared_chars, any_value(file_chunks) AS file_chunks
FROM chunks JOIN owners USING (digest) JOIN sizes USING (file_name) WHERE file_name <> earlier_file GROUP BY file_name, earlier_file""")
    q["dlq_summary_from_state"] = base["dlq_summary"].replace("(failed_timestamp)", "(load_timestamp)")
    q["dead_letters"] = _with(MANIFEST, """,
loads AS (
  SELECT regexp_replace(file_name, '[0-9].csv$', '.csv') AS file_name, load_timestamp AS moment, true AS ok, NULL AS reason FROM pfiles
  UNION ALL
  SELECT regexp_replace(file_name, '[0-9].csv$', '.csv'), load_timestamp, false, failure_reason FROM ffiles
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY file_name, ok ORDER BY moment DESC, reason DESC NULLS LAST) AS rn FROM loads),
states AS (
  SELECT file_name, COUNT(*) FILTER (NOT ok) AS failures, MIN(moment) FILTER (NOT ok) AS first_failed,
    MAX(moment) FILTER (NOT ok) AS last_failed, MAX(reason) FILTER (NOT ok AND rn = 1) AS failure_reason,
    MAX(moment) FILTER (ok) AS loaded
  FROM ranked GROUP BY file_name HAVING COUNT(*) FILTER (NOT ok) > 0
)
SELECT file_name, failures, first_failed, last_failed, failure_reason,
  CASE WHEN loaded > last_failed THEN loaded END AS resolved_at,
  CASE WHEN loaded > last_failed THEN 'RESOLVED' WHEN failures > 1 THEN 'RETRIED' ELSE 'FAILED' END AS state,
  COALESCE(loaded > last_failed, false) AS is_resolved
FROM states""")
    return q
