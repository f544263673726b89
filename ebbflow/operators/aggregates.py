"""Ad-revenue pre-aggregate (A1) and its star-schema output shape (A2).

Plan: filter (pushed to the scan when the input is a columnar table) ->
partial HashAggregate map-side -> one shuffle on the 10 group keys -> final
HashAggregate. Hot keys are combined before the shuffle, so a tenant holding a
third of all rows does not put a third of the rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.functions import columns as X

GROUP_KEYS = [
    ("prefix", "prefix"), ("date", "date"), ("adid", "adid"), ("country", "country"),
    ("os_name", "os_name"), ("device_type", "device_type"),
    ("app_version_short", "app_version_short"), ("pp_game", "game_name"),
    ("pp_ad_format", "ad_format"), ("pp_ad_placement", "ad_placement"),
]


def lookback_filter(clock: C.RunClock, days: int = C.AD_LOOKBACK_DAYS):
    """``date >= run_date - days`` (inclusive, so days + 1 dates)."""
    return F.col("date") >= F.date_sub(F.lit(clock.as_of_date).cast("date"), days)


def ad_preaggregate(processed: DataFrame, clock: C.RunClock) -> DataFrame:
    """Ad impressions of the last 30 days grouped by tenant + 9 dimensions.

    ``ad_count`` = rows, ``ad_revenue`` = sum of the revenue parsed as double
    (unparseable -> ignored), ``aging`` = max date boundaries install -> event.
    NULL keys form their own groups.
    """
    src = processed.where((F.col("pp_event_name") == F.lit(C.AD_EVENT_NAME)) & lookback_filter(clock))
    aging = X.day_boundaries(X.epoch_to_timestamp("installed_at"), X.epoch_to_timestamp("created_at"))
    return (src.groupBy(*[F.col(c).alias(a) for c, a in GROUP_KEYS])
            .agg(F.count(F.lit(1)).alias("ad_count"),
                 F.sum(F.col("pp_ad_revenue").try_cast("double")).alias("ad_revenue"),
                 F.max(aging).cast("bigint").alias("aging"))
            .withColumn("_time", F.lit(clock.as_of)))


def ad_preagg_output(aggregates: DataFrame) -> DataFrame:
    """The 17-column per-tenant table shape plus ``table_name`` for the write (A2)."""
    return aggregates.where(F.col("prefix").isNotNull()).select(
        F.concat(F.col("prefix"), F.lit("_" + C.AD_AGG_TABLE_SUFFIX)).alias("table_name"),
        "date",
        F.col("adid").alias("user_id"),
        "country", "os_name", "device_type", "app_version_short", "game_name",
        "ad_format", "ad_placement",
        F.lit(None).cast("string").alias("iap_product_id"),
        F.col("ad_count").cast("bigint").alias("ad_count"),
        F.col("ad_revenue").cast("double").alias("ad_revenue"),
        F.lit(0).cast("bigint").alias("iap_count"),
        F.lit(0.0).cast("double").alias("iap_revenue"),
        F.lit(0).cast("bigint").alias("session_count"),
        "aging", "_time",
    )
