"""The ad pre-aggregate of the last 30 days as a sliding, mergeable table.

State is the pre-aggregate itself, one partition a date. Counts and revenue
add up and ages take the maximum, so a batch merges with the dates that it
touches, late data included, and no other date is read. Dates that the run's
clock leaves behind are retired with the same commit. A batch counts once,
however often it is run (``sinks.versions``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.operators import aggregates as G
from ebbflow.session import scratch_path
from ebbflow.sinks.versions import VersionedTable

KEYS = [name for _, name in G.GROUP_KEYS]
STATE_SCHEMA = ", ".join(f"{k} {'date' if k == 'date' else 'string'}" for k in KEYS) + ", ad_count bigint, ad_revenue double, aging bigint, _time string"


def _table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, "date")


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEYS).agg(
        F.sum("ad_count").cast("bigint").alias("ad_count"), F.sum("ad_revenue").alias("ad_revenue"),
        F.max("aging").alias("aging"), F.max("_time").alias("_time"))


def first_date(clock: C.RunClock, days: int = C.AD_LOOKBACK_DAYS) -> str:
    return (dt.date.fromisoformat(clock.as_of_date) - dt.timedelta(days=days)).isoformat()


def merge_batch(spark: SparkSession, root: str, processed: DataFrame, clock: C.RunClock, batch: str) -> bool:
    """Add a batch of processed events; False if it has been added before."""
    table = _table(spark, root)
    base = table.current()
    if batch in base.applied:
        return False
    start = first_date(clock)
    own = G.ad_preaggregate(processed, clock).select(*[F.col(c) for c in (*KEYS, "ad_count", "ad_revenue", "aging", "_time")])
    staged = scratch_path(spark, "rolling")
    own.write.parquet(staged)  # read for its dates, then merged
    own = spark.read.schema(own.schema).parquet(staged)
    touched = [r["date"].isoformat() for r in own.select("date").distinct().collect()]  # dates of the window: 31 at the most
    folders = {d: f for d, f in base.folders.items() if d >= start}
    if touched:
        old = table.read(STATE_SCHEMA, touched, base)
        folders |= table.write(_merged(old.unionByName(own)), touched)
    table.commit(base, folders, [*base.applied, batch])
    return True


def read_rolling(spark: SparkSession, root: str, clock: C.RunClock | None = None) -> DataFrame:
    """The state; with a clock, as that run sees it, also if nothing was merged since older dates left the window."""
    state = _table(spark, root).read(STATE_SCHEMA)
    return state if clock is None else state.where(G.lookback_filter(clock))
