"""Run reports over the governance marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.functions import columns as X


def processing_stats(processed: DataFrame, failed: DataFrame) -> DataFrame:
    """Daily success / failure rollup by date (R1 = A4 + A5 + J1 + X5 + X6).

    Both sides are aggregated to one row per date; their rows are then brought
    together by date with a union and one more aggregate, which is the full
    outer join of two keyed sides and needs no join. Rows without a date match
    nothing, so those of either side stay apart. Failures are grouped by the
    date of their failure timestamp.
    """
    ok = processed.groupBy("load_date").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.sum("record_count").alias("total_records"),
    )
    bad = failed.groupBy(F.to_date("failed_timestamp").alias("load_date")).agg(
        F.count(F.lit(1)).alias("failed_files"),
        F.countDistinct("failure_reason").alias("distinct_failures"),
    )
    def undated(side: str):
        return F.when(F.col("load_date").isNull(), F.lit(side)).alias("undated")

    ok, bad = ok.select("*", undated("processed")), bad.select("*", undated("failed"))
    j = ok.unionByName(bad, allowMissingColumns=True).groupBy("load_date", "undated").agg(
        *[F.sum(c).alias(c) for c in ("total_files", "total_records", "failed_files", "distinct_failures")])
    s = F.coalesce(F.col("total_files"), F.lit(0)).cast("bigint")
    f = F.coalesce(F.col("failed_files"), F.lit(0)).cast("bigint")
    combined = j.select(
        F.col("load_date").alias("date"),
        s.alias("successful_files"),
        f.alias("failed_files"),
        F.coalesce(F.col("total_records"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.col("distinct_failures"), F.lit(0)).cast("bigint").alias("distinct_failure_types"),
        X.success_rate(s, f).alias("success_rate"),
    )
    return combined.select(
        "date", "successful_files", "failed_files",
        (F.col("successful_files") + F.col("failed_files")).alias("total_files"),
        "total_records", "distinct_failure_types", "success_rate",
        X.quality_rating("success_rate").alias("quality_rating"),
    ).orderBy(F.col("date").desc_nulls_last())


def dlq_summary(failed: DataFrame) -> DataFrame:
    """Unresolved failures per reason with severity (R2 = A6 + P19 + X4 + O2)."""
    agg = (failed.where(F.col("is_resolved") == F.lit(False))
           .groupBy("failure_reason")
           .agg(F.count(F.lit(1)).alias("failure_count"),
                F.countDistinct("file_name").alias("distinct_files"),
                F.min("failed_timestamp").alias("first_failure"),
                F.max("failed_timestamp").alias("last_failure"),
                F.avg("record_count").alias("avg_record_count")))
    return agg.select(
        "failure_reason", "failure_count", "distinct_files", "first_failure", "last_failure",
        "avg_record_count", X.severity("failure_count").alias("severity"),
    ).orderBy(F.col("failure_count").desc(), F.col("failure_reason").asc_nulls_last())


def dlq_unresolved(failed: DataFrame) -> DataFrame:
    """Unresolved dead-letter rows, newest failure first (O3)."""
    return (failed.where(F.col("is_resolved") == F.lit(False))
            .orderBy(F.col("failed_timestamp").desc_nulls_last(), F.col("file_name")))


def read_stats(staged: DataFrame) -> DataFrame:
    """Files read, records, characters and MB in one aggregation."""
    agg = staged.agg(
        F.countDistinct("file_name").alias("files_read"),
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.sum("content_length"), F.lit(0)).cast("bigint").alias("total_size"),
    )
    return agg.withColumn(
        "total_size_mb", F.round(F.col("total_size").cast("double") / F.lit(1024.0 * 1024.0), 2))


def write_stats(processed: DataFrame) -> DataFrame:
    """Rows written and records in the good-file mart."""
    return processed.agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("bigint").alias("total_records"),
    )


def run_manifest(processed: DataFrame, failed: DataFrame, clock: C.RunClock,
                 environment: str = "development") -> DataFrame:
    """One row per file and outcome (R4). Rows rather than per-status lists,
    so no single cell or task has to hold every file name."""
    ok = processed.select("file_name", "file_hash", F.lit("processed").alias("outcome"),
                          F.lit(None).cast("string").alias("failure_reason"))
    bad = failed.select("file_name", "file_hash", F.lit("failed").alias("outcome"), "failure_reason")
    return ok.unionByName(bad).select(
        "*", F.lit(clock.as_of).cast("timestamp").alias("generated_at"),
        F.lit(environment).alias("environment"))
