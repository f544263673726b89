"""Reshape the provided parquet tables into the engine's input shapes.

``events`` -> raw event rows as a CSV load would deliver them (all strings,
header-style names, file path), and ``documents`` -> a file manifest. The
derivations are deterministic functions of each source row so that the DuckDB
oracle (``ebbflow.plans.oracle``) can repeat them in SQL. They intentionally
reach every branch: NULL / malformed epochs, ms vs s epochs, malformed JSON,
missing keys, NULL group keys, unmatched file names, double-routed rows,
duplicate / empty / oversized / negative-count files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.config import RunClock

# Run clocks used by the registered queries.
EVENTS_CLOCK = RunClock("2024-02-10 00:00:00")
FILES_CLOCK = RunClock("2024-01-31 15:00:00")

# Test tenants: user_id % 5 picks one; user 149 gets an unmatched file name.
ADAPTER_TENANTS = ["ko69zatkf75s", "17ohic5adt6o", "ezkr0rrexnnk", "y2ybrph3py4g", "1ietrnrp8xq8"]
NOMATCH_USER = 149
SOURCE_ROOT = "s3://src"
DLQ_LOCATION = "/dlq"
MANIFEST_BASE_EPOCH = 1706702400  # 2024-01-31 12:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tenant_case(col: str) -> str:
    return "CASE " + col + " % 5 " + " ".join(
        f"WHEN {k} THEN '{t}'" for k, t in enumerate(ADAPTER_TENANTS)) + " END"


# Spark SQL expressions, one per output column (one plan call per column).
_SEC = "(unix_micros(CAST(ts AS TIMESTAMP)) div 1000000)"
_MS = "(unix_micros(CAST(ts AS TIMESTAMP)) div 1000)"
_EVENT_NAME = """CASE WHEN event_type = 'click' THEN 'ad_impression'
  WHEN event_type = 'purchase' THEN 'iap_purchased'
  WHEN event_type = 'view' THEN CASE WHEN event_id % 4 = 0 THEN 'level_started'
    WHEN event_id % 4 = 1 THEN 'Asset_Balance' WHEN event_id % 4 = 2 THEN 'asset_balance'
    WHEN event_id % 8 = 3 THEN 'game_started' END
  WHEN event_type = 'signup' THEN CASE WHEN event_id % 5 = 0 THEN 'earn_asset'
    WHEN event_id % 5 = 1 THEN 'ad_call' END
  ELSE 'level_finished' END"""
_CENTS = "CAST(round(value * 100) AS BIGINT)"

RAW_EVENT_EXPRS = [
    "concat('u', CAST(user_id AS STRING)) AS `{adid}`",
    f"""CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 101 = 0 THEN 'bad'
      WHEN event_id % 3 = 0 THEN CAST({_MS} AS STRING) ELSE CAST({_SEC} AS STRING) END AS `{{created_at}}`""",
    f"""CASE WHEN event_id % 83 = 0 THEN CAST(NULL AS STRING)
      ELSE CAST({_SEC} - (event_id % 40) * 86400 - 3600 AS STRING) END AS `{{installed_at}}`""",
    """CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 10 = 0 THEN ' Session ' ELSE 'session' END
      WHEN event_type = 'signup' THEN CASE WHEN event_id % 9 = 0 THEN 'install_update' ELSE 'install' END
      WHEN event_type = 'error' THEN 'unknown' ELSE 'event' END AS `{activity_kind}`""",
    f"""CASE WHEN event_id % 89 = 0 THEN 'not json' ELSE concat('{{',
      CASE WHEN ({_EVENT_NAME}) IS NULL THEN '' ELSE concat('"adjust_event_name": "', {_EVENT_NAME}, '", ') END,
      '"game": "g', CAST(user_id % 3 AS STRING), '", ',
      '"ad_format": "', CASE WHEN event_id % 2 = 0 THEN 'banner' ELSE 'video' END, '", ',
      CASE WHEN event_id % 7 = 0 THEN '' ELSE concat('"ad_placement": "p', CAST(user_id % 3 AS STRING), '", ') END,
      '"ad_revenue": "', CAST({_CENTS} div 100 AS STRING), '.', lpad(CAST({_CENTS} % 100 AS STRING), 2, '0'),
      '"}}') END AS `{{publisher_parameters}}`""",
    "CASE user_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' WHEN 2 THEN 'TR' END AS `{country}`",
    """CASE WHEN user_id % 6 = 0 THEN 'Rio, "Lagoa"\nBR' ELSE concat('city', CAST(user_id % 6 AS STRING)) END
      AS `{city}`""",
    "CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS `{os_name}`",
    "CASE user_id % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'tablet' END AS `{device_type}`",
    "concat('1.', CAST(user_id % 4 AS STRING)) AS `{app_version_short}`",
    f"""CASE WHEN user_id = {NOMATCH_USER} THEN '{SOURCE_ROOT}/nomatch.csv.gz'
      ELSE concat('{SOURCE_ROOT}/', {_tenant_case('user_id')}, '_',
                  date_format(CAST(ts AS TIMESTAMP), 'yyyy-MM-dd'), 'T00.csv.gz') END AS filename""",
]


def raw_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> raw CSV-like rows."""
    return events.selectExpr(*RAW_EVENT_EXPRS)


MANIFEST_EXPRS = [
    "concat('file_', CAST(CASE WHEN doc_id % 100 = 1 THEN doc_id - 1 ELSE doc_id END AS STRING), '.csv') AS file_name",
    f"timestamp_seconds({MANIFEST_BASE_EPOCH} - (doc_id % 10) * 86400) AS load_timestamp",
    "md5(text) AS file_hash",
    """CAST(CASE WHEN doc_id % 199 = 0 THEN NULL WHEN doc_id % 211 = 0 THEN 1000001
      WHEN doc_id % 223 = 0 THEN -1
      ELSE char_length(text) - char_length(replace(text, '\n', '')) END AS BIGINT) AS record_count""",
    "CASE WHEN doc_id % 53 = 0 THEN '' WHEN doc_id % 59 = 0 THEN CAST(NULL AS STRING) ELSE text END AS raw_content",
]


def file_manifest(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text, ...) -> manifest(file_name, load_timestamp, file_hash,
    record_count, raw_content)."""
    return documents.selectExpr(*MANIFEST_EXPRS)
