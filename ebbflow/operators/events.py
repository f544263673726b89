"""Raw events -> processed events (normalise, parse, filter, derive)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.functions import columns as X
from ebbflow.functions.names import normalize_columns


# Columns the processing and aggregation steps read; absent ones are added as
# NULL strings so a file set without them still processes (rows then simply
# fail the filters or form NULL groups).
REFERENCED_COLUMNS = ["adid", "created_at", "installed_at", "activity_kind", "publisher_parameters",
                      "country", "os_name", "device_type", "app_version_short"]


FILTER_COLUMNS = ["created_at", "activity_kind"]  # what process_events filters on


def ensure_columns(df: DataFrame, columns=REFERENCED_COLUMNS) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if not missing:
        return df
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def attach_tenant(raw: DataFrame, path_col: str = "filename", out: str = "prefix") -> DataFrame:
    """Add the tenant column parsed from the source path."""
    return raw.withColumn(out, X.tenant_from_path(path_col))


def process_events(raw: DataFrame, clock: C.RunClock) -> DataFrame:
    """Normalised raw columns + ``pp_*`` + ``_time`` + ``date``, keeping rows with
    a non-null ``created_at`` and an accepted activity kind (P1-P3, X1, X2).

    JSON is parsed once per row (``json_tuple`` streams the text and picks the
    five keys); malformed JSON gives NULL parameters. Unparseable epochs give a
    NULL ``date``.
    """
    df = ensure_columns(normalize_columns(raw))
    filtered = df.where(F.col("created_at").isNotNull() & X.activity_allowed("activity_kind"))
    keep = [F.col(f"`{c}`") for c in df.columns]
    return filtered.select(
        *keep, X.publisher_params_tuple("publisher_parameters"),
        F.lit(clock.as_of).alias("_time"),
        X.epoch_to_date("created_at").alias("date"),
    )


BAD_CREATED_AT, BAD_JSON = "BAD_CREATED_AT", "BAD_JSON"


def reject_reason() -> Column:
    """Why a row's values do not parse (H4): the first of an epoch that is no number and parameters that are no JSON."""
    bad_epoch = F.col("created_at").isNotNull() & X.epoch_to_date("created_at").isNull()
    text = F.col("publisher_parameters")
    return F.when(bad_epoch, F.lit(BAD_CREATED_AT)).when(text.isNotNull() & F.try_parse_json(text).isNull(), F.lit(BAD_JSON))


def rejected_rows(raw: DataFrame) -> DataFrame:
    """Rows that pass the filters and whose values do not parse, with ``reject_reason``.

    Upstream ends the whole run at the first such row. Here processing goes on with NULLs, and these rows tell which.
    """
    df = ensure_columns(normalize_columns(raw))
    kept = df.where(F.col("created_at").isNotNull() & X.activity_allowed("activity_kind"))
    return kept.select("*", reject_reason().alias("reject_reason")).where(F.col("reject_reason").isNotNull())


def json_params(raw: DataFrame) -> DataFrame:
    """The five publisher parameters for every raw row (X1), unfiltered."""
    df = normalize_columns(raw)
    return df.select("adid", "created_at", "publisher_parameters",
                     X.publisher_params_tuple("publisher_parameters"))


def epoch_dates(raw: DataFrame) -> DataFrame:
    """Epoch text -> epoch seconds and UTC date for every raw row."""
    df = normalize_columns(raw)
    ts = X.epoch_to_timestamp("created_at")
    return df.select(
        "adid", "created_at",
        F.unix_seconds(ts).alias("created_epoch_s"),
        F.to_date(ts).alias("date"),
    )


def install_age_days(processed: DataFrame) -> DataFrame:
    """Date boundaries between install and event time per processed row."""
    return processed.select(
        "adid", "created_at", "installed_at",
        X.day_boundaries(X.epoch_to_timestamp("installed_at"),
                         X.epoch_to_timestamp("created_at")).cast("bigint").alias("aging"),
    )


def exclude_columns(processed: DataFrame, excluded=C.ROUTED_EXCLUDED_COLUMNS) -> DataFrame:
    """Drop the internal columns that routed tables do not carry."""
    return processed.drop(*excluded)


def distinct_tenants(processed: DataFrame, col: str = "prefix") -> DataFrame:
    """Distinct non-null tenants (P5). ``''`` (unmatched file name) survives."""
    return processed.select(col).where(F.col(col).isNotNull()).distinct()


def raw_event_violations(raw: DataFrame) -> DataFrame:
    """Rows the processing filter rejects, with the first failed rule (Q7)."""
    df = normalize_columns(raw)
    reason = (F.when(F.col("created_at").isNull(), F.lit("created_at_is_null"))
              .when(~F.coalesce(X.activity_allowed("activity_kind"), F.lit(False)),
                    F.lit("activity_kind_not_accepted")))
    cols = [c for c in ("adid", "created_at", "activity_kind", "filename") if c in df.columns]
    return df.select(*cols, reason.alias("violation")).where(F.col("violation").isNotNull())


def schema_contract(raw: DataFrame, required=C.REQUIRED_COLUMNS,
                    epoch_cols=C.TIMESTAMP_COLUMNS) -> DataFrame:
    """Contract check of a raw frame against the declared columns (Q8).

    One aggregation pass computes, for every declared column that is present,
    its NULL count and (epoch columns) the number of non-null values that do
    not parse as an integer epoch. Missing columns are reported with NULL
    counts. Output: column_name, expected_type, is_present, null_count,
    cast_failures.
    """
    df = normalize_columns(raw)
    present = set(df.columns)
    aggs = []
    for c in required:
        if c not in present:
            continue
        aggs.append(F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"n__{c}"))
        if c in epoch_cols:
            bad = F.col(c).isNotNull() & X.tolerant_bigint(c).isNull()
            aggs.append(F.sum(F.when(bad, 1).otherwise(0)).alias(f"b__{c}"))
    stats = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
    rows = []
    for c in required:
        etype = "epoch" if c in epoch_cols else "string"
        if c in present:
            bad = F.col(f"b__{c}") if c in epoch_cols else F.lit(0)
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(etype).alias("expected_type"),
                                 F.lit(True).alias("is_present"),
                                 F.coalesce(F.col(f"n__{c}"), F.lit(0)).cast("bigint").alias("null_count"),
                                 F.coalesce(bad, F.lit(0)).cast("bigint").alias("cast_failures")))
        else:
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(etype).alias("expected_type"),
                                 F.lit(False).alias("is_present"),
                                 F.lit(None).cast("bigint").alias("null_count"),
                                 F.lit(None).cast("bigint").alias("cast_failures")))
    return stats.select(F.inline(F.array(*rows)))
