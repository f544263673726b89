"""Column -> Column helpers. All built-in Spark expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbflow import config as C


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_bigint(c: Column | str) -> Column:
    """String -> BIGINT, NULL on garbage instead of failing the job.

    Integer text takes the fast path; decimal text is rounded half-up to the
    nearest integer (``'1700000000.9'`` -> 1700000001), matching the
    reproduced ``CAST(x AS BIGINT)``.
    """
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(
        s.try_cast("bigint"),
        F.round(s.try_cast("decimal(38,6)"), 0).try_cast("bigint"),
    )


def epoch_to_timestamp(c: Column | str) -> Column:
    """Epoch seconds or milliseconds (>= 1e12) -> TIMESTAMP (UTC)."""
    n = tolerant_bigint(c)
    return (F.when(n >= F.lit(C.EPOCH_MS_THRESHOLD), F.timestamp_millis(n))
            .otherwise(F.timestamp_seconds(n)))


def epoch_to_date(c: Column | str) -> Column:
    return F.to_date(epoch_to_timestamp(c))


def day_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of calendar-date boundaries between two timestamps (end - start).

    This is DATE_DIFF('day', start, end) semantics: 23:59 -> 00:01 counts 1.
    """
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def publisher_params_tuple(c: Column | str) -> Column:
    """The five parameters as ``pp_*`` columns from one streaming parse
    (``json_tuple``: a generator, so one per ``select``). Values come back as
    text (numbers keep their JSON spelling); malformed JSON gives NULLs."""
    return F.json_tuple(_c(c), *[k for k, _ in C.PUBLISHER_PARAM_KEYS]).alias(
        *[name for _, name in C.PUBLISHER_PARAM_KEYS])


def tenant_from_path(c: Column | str) -> Column:
    """Tenant id = text before the last ``_YYYY-MM-DDT`` in the path; '' if none."""
    return F.regexp_extract(_c(c), C.TENANT_PATTERN, 1)


def normalized_activity(c: Column | str) -> Column:
    return F.lower(F.trim(_c(c).cast("string")))


def activity_allowed(c: Column | str) -> Column:
    return normalized_activity(c).isin(C.ALLOWED_ACTIVITY_KINDS)


def table_name(tenant: Column | str, suffix: Column | str) -> Column:
    return F.concat(_c(tenant), F.lit("_"), F.lower(_c(suffix)))


def content_is_valid(content: Column | str) -> Column:
    """NULL -> false, empty -> false, else true."""
    c = _c(content)
    return F.when(c.isNull(), F.lit(False)).when(F.char_length(c) == 0, F.lit(False)).otherwise(F.lit(True))


DLQ_LAYOUTS = {"flat": None, "day": "yyyy/MM/dd", "hour": "yyyy/MM/dd/HH"}


def dlq_path(base: Column | str, ts: Column | str, file_name: Column | str,
             layout: str = "day") -> Column:
    """``<base>/<date dirs>/<file_name>``. A NULL part becomes empty but keeps
    its separator (``concat`` that skips NULLs), e.g. ``base/2024/01/31/``."""
    if layout not in DLQ_LAYOUTS:
        raise ValueError(f"layout must be one of {sorted(DLQ_LAYOUTS)}")
    fmt = DLQ_LAYOUTS[layout]
    parts = [_c(base)]
    if fmt is not None:
        parts.append(F.date_format(_c(ts), fmt))
    parts.append(_c(file_name))
    out = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit("/"))
        out.append(F.coalesce(p, F.lit("")))
    return F.concat(*out)


def bucket_desc(c: Column | str, thresholds, default: str, inclusive: bool) -> Column:
    """First-match CASE over descending thresholds."""
    c = _c(c)
    expr = None
    for bound, label in thresholds:
        cond = (c >= bound) if inclusive else (c > bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def severity(failure_count: Column | str) -> Column:
    return bucket_desc(failure_count, C.SEVERITY_THRESHOLDS, C.SEVERITY_DEFAULT, inclusive=False)


def quality_rating(success_rate: Column | str) -> Column:
    return bucket_desc(success_rate, C.RATING_THRESHOLDS, C.RATING_DEFAULT, inclusive=True)


def success_rate(successful: Column | str, failed: Column | str) -> Column:
    """round(100 * ok / (ok + failed), 2) as DOUBLE; 0 when there is nothing."""
    ok = F.coalesce(_c(successful), F.lit(0)).cast("double")
    bad = F.coalesce(_c(failed), F.lit(0)).cast("double")
    total = ok + bad
    return F.when(total > 0, F.round(F.lit(100.0) * ok / total, 2)).otherwise(F.lit(0.0))
