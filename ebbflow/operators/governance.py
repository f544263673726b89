"""File-manifest governance: stage -> validate -> good files / dead-letter files.

Input is a manifest with one row per source file:
``file_name, load_timestamp, file_hash, record_count, raw_content``.
Every step is a narrow projection/filter over that frame (no shuffle), so the
whole DAG is one pipelined stage per consumer; ``as_of`` replaces every
``current_timestamp`` / ``current_date`` so all consumers agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.functions import columns as X


def _ts(clock: C.RunClock):
    return F.lit(clock.as_of).cast("timestamp")


def _run_date(clock: C.RunClock):
    return F.lit(clock.as_of_date).cast("date")


def stage_raw_files(manifest: DataFrame, clock: C.RunClock,
                    retention_days: int = C.RETENTION_DAYS) -> DataFrame:
    """Keep files loaded since midnight ``retention_days`` ago (P9); add content
    length and the content flag (P11)."""
    cutoff = F.date_sub(_run_date(clock), retention_days).cast("timestamp")
    if "content_bytes" in manifest.columns:  # a manifest without contents carries their size
        length, valid = F.col("content_bytes"), F.coalesce(F.col("content_bytes") > 0, F.lit(False))
    else:
        length, valid = F.char_length("raw_content").cast("bigint"), X.content_is_valid("raw_content")
    return manifest.where(F.col("load_timestamp") >= cutoff).select(
        "file_name", "load_timestamp", "file_hash", "record_count", "raw_content",
        length.alias("content_length"),
        _ts(clock).alias("processed_at"),
        valid.alias("is_valid_content"),
    )


def validate_files(staged: DataFrame, clock: C.RunClock,
                   max_records: int = C.MAX_RECORDS_PER_FILE,
                   explicit_unknown_reason: bool = False) -> DataFrame:
    """First-match failure reason (P12), validity flag (P13) and status.

    A NULL or negative ``record_count`` is invalid with a NULL reason, as in the
    reproduced model; ``explicit_unknown_reason=True`` labels it instead.
    """
    rc = F.col("record_count")
    reason = (F.when(F.col("is_valid_content") == F.lit(False), F.lit(C.REASON_INVALID_CONTENT))
              .when(rc == 0, F.lit(C.REASON_EMPTY_FILE))
              .when(rc > max_records, F.lit(C.REASON_TOO_LARGE)))
    valid = F.when((F.col("is_valid_content") == F.lit(True)) & (rc > 0) & (rc <= max_records),
                   F.lit(True)).otherwise(F.lit(False))
    if explicit_unknown_reason:
        reason = F.when(~valid & reason.isNull(), F.lit("UNKNOWN_RECORD_COUNT")).otherwise(reason)
    return staged.select(
        "file_name", "load_timestamp", "file_hash", "record_count",
        valid.alias("is_valid_file"),
        reason.alias("validation_error"),
        _ts(clock).alias("validation_timestamp"),
    ).withColumn(
        "processing_status",
        F.when(F.col("is_valid_file"), F.lit(C.STATUS_READY)).otherwise(F.lit(C.STATUS_FAILED)),
    )


def processed_files(validated: DataFrame, clock: C.RunClock) -> DataFrame:
    """Good-file mart (P15 good side + P17)."""
    good = validated.where(F.col("is_valid_file") & (F.col("processing_status") == F.lit(C.STATUS_READY)))
    return good.select(
        "file_name", "load_timestamp",
        F.to_date("load_timestamp").alias("load_date"),
        "file_hash", "record_count", "processing_status",
        _ts(clock).alias("inserted_at"),
        _ts(clock).alias("updated_at"),
    )


def failed_files(validated: DataFrame, clock: C.RunClock,
                 dlq_location: str, layout: str = "day") -> DataFrame:
    """Dead-letter mart (P15 bad side + P16) with the DLQ location."""
    bad = validated.where(~F.col("is_valid_file") | (F.col("processing_status") == F.lit(C.STATUS_FAILED)))
    return bad.select(
        "file_name", "load_timestamp",
        F.to_date("validation_timestamp").alias("failure_date"),
        "file_hash", "record_count",
        F.col("validation_error").alias("failure_reason"),
        "processing_status",
        F.col("validation_timestamp").alias("failed_timestamp"),
        X.dlq_path(F.lit(dlq_location.rstrip("/")), F.col("validation_timestamp"),
                   F.col("file_name"), layout).alias("file_location_dlq"),
        _ts(clock).alias("dlq_inserted_at"),
        F.lit(False).alias("is_resolved"),
    )


def carry_resolution(failed: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Keep ``is_resolved`` from an earlier dead-letter table across a rebuild,
    matched on (file_name, file_hash). The previous table has one row per key
    at most (it is the output of this function), so the join is key-to-key."""
    if previous is None:
        return failed
    prev = (previous.where(F.col("is_resolved"))
            .select("file_name", "file_hash", F.lit(True).alias("__was_resolved"))
            .dropDuplicates(["file_name", "file_hash"]))
    return (failed.join(prev, ["file_name", "file_hash"], "left")
            .withColumn("is_resolved", F.coalesce(F.col("__was_resolved"), F.col("is_resolved")))
            .select(*failed.columns))


def content_checks(manifest: DataFrame, max_size: int = C.CONTENT_WARN_CHARS) -> DataFrame:
    """All content errors and warnings per file, not first-match.

    Output: file_name, is_valid, errors ARRAY<STRING>, warnings ARRAY<STRING>.
    NULL content is treated as empty (null-safe).
    """
    content, name = F.col("raw_content"), F.col("file_name")
    empty = content.isNull() | (content == F.lit(""))
    no_comma = content.isNotNull() & (F.instr(content, ",") == 0)
    no_name = name.isNull() | (name == F.lit(""))
    errors = F.filter(F.array(
        F.when(empty, F.lit(C.CONTENT_ERROR_EMPTY)),
        F.when(no_comma, F.lit(C.CONTENT_ERROR_NO_COMMA)),
        F.when(no_name, F.lit(C.CONTENT_ERROR_NO_NAME)),
    ), lambda x: x.isNotNull())
    warnings = F.filter(F.array(
        F.when(F.char_length(content) > max_size,
               F.lit(C.CONTENT_WARNING_SIZE.format(max_size=max_size))),
    ), lambda x: x.isNotNull())
    return manifest.select(
        "file_name",
        (F.size(errors) == 0).alias("is_valid"),
        errors.alias("errors"),
        warnings.alias("warnings"),
    )


def dedupe_latest(frame: DataFrame, key: str = "file_name",
                  order=("load_timestamp", "file_hash")) -> DataFrame:
    """Latest row per key (by ``order``, descending).

    The winner is found on narrow columns: the order and a hash of the whole
    row, as a ``max`` aggregate that combines map-side, so a key holding a third
    of all rows is reduced before the shuffle and no content is sorted. The
    content is then read again and joined to the winners. Rows alike in all
    columns are one: among them a second aggregate, on those keys only, keeps
    one.
    """
    cols = frame.columns
    rank = F.struct(*[F.col(f"`{o}`") for o in order], F.xxhash64(*[F.col(f"`{c}`") for c in cols]),
                    F.hash(*[F.col(f"`{c}`") for c in cols]))
    parts = frame.select(F.col(f"`{key}`").alias("k0"), rank.alias("rank"))
    best = parts.groupBy("k0", "rank").agg(F.count(F.lit(1)).alias("n")).groupBy("k0").agg(
        F.max(F.struct("rank", "n")).alias("best"))
    winners = best.select("k0", F.col("best.rank").alias("rank"), F.col("best.n").alias("n"))
    row = frame.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(f"`{key}`").alias("own"), rank.alias("own_rank"))
    found = row.join(winners, F.col("own").eqNullSafe(F.col("k0")) & F.col("own_rank").eqNullSafe(F.col("rank")))
    alone = found.where("n = 1").select("row")
    alike = found.where("n > 1").groupBy("k0", "rank").agg(F.any_value("row").alias("row")).select("row")
    return alone.unionByName(alike).select(*[F.col("row").getField(c).alias(c) for c in cols])
