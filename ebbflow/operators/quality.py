"""Data-quality checks. Each returns the *violating rows* (the usual data-test
convention: a check passes when its frame is empty); ``run_checks`` folds them
into a tidy ``(check_name, column_name, violations, status)`` frame.

Column checks over many columns are evaluated in one aggregation pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow import config as C

PROCESSED_NOT_NULL = ["file_name", "load_timestamp", "load_date", "file_hash", "record_count",
                      "processing_status", "inserted_at", "updated_at"]


def not_null_counts(frame: DataFrame, columns=PROCESSED_NOT_NULL) -> DataFrame:
    """NULL count per column in one pass (Q1). Output: column_name, null_count."""
    stats = frame.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("null_count")) for c in columns]
    return stats.select(F.inline(F.array(*rows)))


def not_null_violations(frame: DataFrame, column: str) -> DataFrame:
    return frame.where(F.col(column).isNull())


def unique_violations(frame: DataFrame, column: str = "file_name") -> DataFrame:
    """Values occurring more than once, NULLs excluded (Q2)."""
    return (frame.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def duplicate_files(frame: DataFrame, column: str = "file_name") -> DataFrame:
    """``group by file_name having count(*) > 1`` (Q5 / A7), NULL is a group."""
    return (frame.groupBy(column)
            .agg(F.count(F.lit(1)).alias("occurrence_count"))
            .where(F.col("occurrence_count") > 1))


def accepted_values_violations(frame: DataFrame, column: str = "processing_status",
                               values=(C.STATUS_READY,)) -> DataFrame:
    """Values outside the accepted set, with counts; NULL is not a violation (Q3)."""
    return (frame.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def greater_than_zero_violations(frame: DataFrame, column: str = "record_count") -> DataFrame:
    """Rows where the column is <= 0 or NULL (Q4)."""
    c = F.col(column)
    return frame.where((c <= 0) | c.isNull())


def freshness(frame: DataFrame, clock: C.RunClock, column: str = "load_timestamp",
              warn_hours: int = C.FRESHNESS_WARN_HOURS,
              error_hours: int = C.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Source freshness on ``max(column)`` against the run clock (Q6).

    Output: max_loaded_at, snapshotted_at, age_seconds, status (pass/warn/error).
    """
    snap = F.lit(clock.as_of).cast("timestamp")
    agg = frame.agg(F.max(column).alias("max_loaded_at"))
    age = (F.unix_seconds(snap) - F.unix_seconds(F.col("max_loaded_at"))).cast("bigint")
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age > error_hours * 3600, F.lit("error"))
              .when(age > warn_hours * 3600, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return agg.select("max_loaded_at", snap.alias("snapshotted_at"), age.alias("age_seconds"),
                      status.alias("status"))


def run_checks(processed: DataFrame, values=(C.STATUS_READY,)) -> DataFrame:
    """The declared tests of the good-file mart, as one tidy result frame.

    The mart is read once: everything is counted per file name first, and the
    file names' counts are then added up.
    """
    one = F.lit(1)
    status, records = F.col("processing_status"), F.col("record_count")
    by_file = processed.groupBy("file_name").agg(
        F.count(one).alias("n"),
        *[F.count(F.when(F.col(c).isNull(), one)).alias(f"null_{c}") for c in PROCESSED_NOT_NULL if c != "file_name"],
        F.count(F.when(status.isNotNull() & ~status.isin(list(values)), one)).alias("other_status"),
        F.count(F.when((records <= 0) | records.isNull(), one)).alias("no_records"))
    named, repeated = F.col("file_name").isNotNull(), F.col("n") > 1
    sums = by_file.agg(
        F.sum(F.when(~named, F.col("n"))).alias("null_file_name"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in PROCESSED_NOT_NULL if c != "file_name"],
        F.count(F.when(named & repeated, one)).alias("repeated_names"),
        F.sum("other_status").alias("other_status"), F.sum("no_records").alias("no_records"),
        F.count(F.when(repeated, one)).alias("repeated"))
    checks = [("not_null", c, f"null_{c}") for c in PROCESSED_NOT_NULL] + [
        ("unique", "file_name", "repeated_names"), ("accepted_values", "processing_status", "other_status"),
        ("assert_greater_than_zero", "record_count", "no_records"), ("no_duplicate_files", "file_name", "repeated")]
    rows = [F.struct(F.lit(name).alias("check_name"), F.lit(column).alias("column_name"),
                     F.coalesce(F.col(count), F.lit(0)).cast("bigint").alias("violations")) for name, column, count in checks]
    v = F.col("violations")
    return sums.select(F.inline(F.array(*rows))).withColumn("status", F.when(v == 0, F.lit("pass")).otherwise(F.lit("fail")))
