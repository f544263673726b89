"""Exact distinct counts that merge: bitmaps kept per day.

``count(distinct file_name)`` over all days reads all days again. Here every
file name gets a number, once, and a day keeps for each failure reason a bitmap
of the numbers that it saw, next to its count, sums and times. Bitmaps are
joined by OR, so any set of days gives the exact distinct count from state
alone. Numbers are dense within 64 groups by the name's hash, so each group is
numbered by its own task and bitmaps stay as long as the names are many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions import columns as X

GROUPS = 64


def number_names(names: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(file_name, part, number)``: the known ones and, numbered after them, the new ones of ``names (file_name)``."""
    part = F.pmod(F.xxhash64("file_name"), F.lit(GROUPS)).cast("int")
    new = names.where(F.col("file_name").isNotNull()).select("file_name").distinct()
    if known is not None:
        new = new.join(known.select("file_name"), "file_name", "left_anti")
    new = new.withColumn("part", part)
    order = F.row_number().over(Window.partitionBy("part").orderBy("file_name")).cast("long")
    if known is None:
        return new.withColumn("number", order - 1).select("file_name", "part", "number")
    after = known.groupBy("part").agg(F.max("number").alias("last"))
    new = new.withColumn("place", order).join(F.broadcast(after), "part", "left")  # GROUPS rows
    return known.unionByName(new.select("file_name", "part", (F.col("place") + F.coalesce("last", F.lit(-1))).alias("number")))


def failure_state(failed: DataFrame, numbers: DataFrame) -> DataFrame:
    """State of unresolved failures per day and reason, bitmaps in rows of 32,768 numbers.

    Measures stand in the row of no bitmap, so that they count once.
    """
    open_rows = failed.where(F.col("is_resolved") == F.lit(False)).withColumn("day", F.to_date("failed_timestamp"))
    measures = open_rows.groupBy("day", "failure_reason").agg(
        F.count(F.lit(1)).alias("failures"), F.min("failed_timestamp").alias("first_failure"), F.max("failed_timestamp").alias("last_failure"),
        F.sum("record_count").alias("records"), F.count("record_count").alias("counted"))
    seen = open_rows.join(numbers, "file_name").select("day", "failure_reason", "part", F.bitmap_bucket_number("number").alias("bucket"),
                                                       F.bitmap_bit_position("number").alias("bit"))
    bitmaps = seen.groupBy("day", "failure_reason", "part", "bucket").agg(F.bitmap_construct_agg("bit").alias("names"))
    return measures.unionByName(bitmaps, allowMissingColumns=True)


def dlq_summary(state: DataFrame) -> DataFrame:
    """The dead-letter summary of the days in ``state``, equal to ``reports.dlq_summary`` over their rows."""
    merged = state.groupBy("failure_reason", "part", "bucket").agg(
        F.sum("failures").alias("failures"), F.min("first_failure").alias("first_failure"), F.max("last_failure").alias("last_failure"),
        F.sum("records").alias("records"), F.sum("counted").alias("counted"),
        F.when(F.count("names") > 0, F.bitmap_count(F.bitmap_or_agg("names"))).alias("names"))
    found = merged.groupBy("failure_reason").agg(
        F.sum("failures").cast("long").alias("failure_count"), F.coalesce(F.sum("names"), F.lit(0)).cast("long").alias("distinct_files"),
        F.min("first_failure").alias("first_failure"), F.max("last_failure").alias("last_failure"),
        (F.sum("records").cast("double") / F.nullif(F.sum("counted"), F.lit(0))).alias("avg_record_count"))
    return found.withColumn("severity", X.severity("failure_count")).orderBy(F.col("failure_count").desc(), F.col("failure_reason").asc_nulls_last())
