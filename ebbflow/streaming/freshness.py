"""Freshness alerts from timers (Q6).

The batch check asks, once, how old the newest load is. Here every source has
keyed state on disk (its last load) and two event-time timers, 2 and 4 hours
after it: a load moves them, and the one that the watermark reaches first gives
a ``warn``, the other an ``error``. A gap between two loads that arrive in one
micro-batch is told when the later one is seen, so a replay in any number of
batches gives the same alerts as the rule over the whole table: each load that
is followed by nothing for more than the limit, up to the end of what is known.

Times count in milliseconds, as watermarks do. What is known ends one millisecond
before the newest load of all sources (the watermark), so that others of the same
moment may still arrive; a load from before that is late and moves nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ebbflow import config as C

LIMITS = (("warn", C.FRESHNESS_WARN_HOURS * 3_600_000), ("error", C.FRESHNESS_ERROR_HOURS * 3_600_000))
ALERT_DDL = "source string, last_loaded_ms long, status string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FreshnessTimers(StatefulProcessor):
    """State of a source: its last load and how many of its limits have been told."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "ms long, told int")

    def _alerts(self, key, last: int, told: int, until: int) -> tuple[list, int]:
        """Limits that ``until`` is beyond and that were not told yet."""
        due = sum(until - last > limit for _, limit in LIMITS)
        return [(key[0], last, status) for status, _ in LIMITS[told:due]], max(told, due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = np.sort(np.concatenate([df["ms"].to_numpy(np.int64) for df in rows]))
        state = self._last.get()
        last, told = (None, 0) if state is None else (state[0], state[1])
        out = []
        before = last
        for ms in times.tolist():
            if last is not None and ms > last:
                found, _ = self._alerts(key, last, told, ms)
                out += found
            if last is None or ms > last:
                last, told = ms, 0
        if last != before:
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
            for _, limit in LIMITS:
                self._handle.registerTimer(last + limit + 1)
        self._last.update((last, told))
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, told = self._last.get()
        out, told = self._alerts(key, last, told, expiredTimerInfo.getExpiryTimeInMs())
        self._last.update((last, told))
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["source", "last_loaded_ms", "status"])


def freshness_alerts(loads: DataFrame) -> DataFrame:
    """Alerts of a stream of ``(source, load_timestamp)``."""
    timed = loads.select("source", "load_timestamp", F.unix_millis("load_timestamp").alias("ms")).where("load_timestamp IS NOT NULL")
    return (timed.withWatermark("load_timestamp", "1 millisecond").groupBy("source")
            .transformWithStateInPandas(FreshnessTimers(), outputStructType=ALERT_DDL, outputMode="Append", timeMode="EventTime"))


def run_alerts(spark: SparkSession, loads: DataFrame, out: str, checkpoint: str) -> None:
    """Write the alerts of everything that has arrived since the last run."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, ROCKSDB)
    try:
        (freshness_alerts(loads).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(out).awaitTermination())
    finally:
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
