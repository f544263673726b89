"""The life of a dead letter: failed, retried, resolved.

Every run leaves events about files: a file failed, was tried again, or was
loaded well. A file's state is the ordered fold of its events, and the fold is
an aggregate, so states of parts merge and a hot file is combined before the
shuffle: first and last failure, the number of failures, the reason of the last
one, and the last good load. A file is resolved if it was loaded well after its
last failure, and fails again if another failure follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAILED, LOADED = "FAILED", "LOADED"


def file_events(processed: DataFrame, failed: DataFrame) -> DataFrame:
    """``(file_name, at, event, reason)`` of a run's marts, by the time when the file was loaded."""
    good = processed.select("file_name", F.col("load_timestamp").alias("at"), F.lit(LOADED).alias("event"), F.lit(None).cast("string").alias("reason"))
    bad = failed.select("file_name", F.col("load_timestamp").alias("at"), F.lit(FAILED).alias("event"), F.col("failure_reason").alias("reason"))
    return good.unionByName(bad)


def fold(events: DataFrame) -> DataFrame:
    """Mergeable state per file. Events of one moment: the failure counts as the later one."""
    is_bad = F.col("event") == FAILED
    last = F.max(F.when(is_bad, F.struct(F.col("at").alias("at"), F.col("reason").alias("reason"))))
    return events.groupBy("file_name").agg(
        F.count(F.when(is_bad, 1)).alias("failures"), F.min(F.when(is_bad, F.col("at"))).alias("first_failed"),
        last.alias("last_failure"), F.max(F.when(F.col("event") == LOADED, F.col("at"))).alias("last_loaded"))


def merge(states: DataFrame) -> DataFrame:
    """One state per file from the states of parts of its events."""
    return states.groupBy("file_name").agg(
        F.sum("failures").cast("bigint").alias("failures"), F.min("first_failed").alias("first_failed"),
        F.max("last_failure").alias("last_failure"), F.max("last_loaded").alias("last_loaded"))


def dead_letters(states: DataFrame) -> DataFrame:
    """Files that ever failed, with their state: RESOLVED, RETRIED (failed more than once) or FAILED."""
    resolved = F.coalesce(F.col("last_loaded") > F.col("last_failure.at"), F.lit(False))
    return states.where("failures > 0").select(
        "file_name", "failures", "first_failed", F.col("last_failure.at").alias("last_failed"),
        F.col("last_failure.reason").alias("failure_reason"), F.when(resolved, F.col("last_loaded")).alias("resolved_at"),
        F.when(resolved, F.lit("RESOLVED")).when(F.col("failures") > 1, F.lit("RETRIED")).otherwise(F.lit("FAILED")).alias("state"),
        resolved.alias("is_resolved"))


def resolve(failed: DataFrame, states: DataFrame) -> DataFrame:
    """The dead-letter mart with ``is_resolved`` set for files that were loaded well since."""
    done = dead_letters(states).where("is_resolved").select(F.col("file_name").alias("__file"), F.lit(True).alias("__done"))
    return (failed.join(done, failed["file_name"] == done["__file"], "left")
            .withColumn("is_resolved", F.col("is_resolved") | F.coalesce("__done", F.lit(False))).select(*failed.columns))
