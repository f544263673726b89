"""Column-name normalisation (schema-level, runs on the driver over names only)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """Drop ``{`` / ``}``, trim whitespace, lowercase."""
    return name.replace("{", "").replace("}", "").strip().lower()


def unique_clean_names(names: list[str], reserved: Iterable[str] = ()) -> list[str]:
    """Clean every name; on a collision the later column gets ``_2``, ``_3``...

    Without this, two raw headers such as ``Country`` and ``{country}`` would
    end up as one ambiguous name and every reference to it would fail. A name in
    ``reserved`` counts as taken.
    """
    out: list[str] = []
    seen: set[str] = set(reserved)
    for n in names:
        base = clean_name(n)
        cand, k = base, 2
        while cand in seen:
            cand = f"{base}_{k}"
            k += 1
        seen.add(cand)
        out.append(cand)
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its cleaned, collision-free name (no data pass)."""
    new = unique_clean_names(df.columns)
    if new == df.columns:
        return df
    return df.toDF(*new)


def fresh_names(taken: list[str], *wanted: str) -> list[str]:
    """Names that no column has, in Spark's case-insensitive sense."""
    seen, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in seen:
            name = "_" + name
        seen.add(name.lower())
        out.append(name)
    return out
