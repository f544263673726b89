"""Column types of text columns, as a mergeable aggregate.

Every value has the set of types whose grammar it fits, as bits; a column fits
the types that all its values fit, the ``bit_and`` of them. So types of parts
(files, batches, runs) merge to those of the whole, in one pass over all
columns and without a sample. Null and empty values fit everything; a column
without others is text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The types, from the most special one on, and the grammar of each. A bigint is a double, a date a timestamp.
GRAMMARS = [
    ("boolean", "^([Tt][Rr][Uu][Ee]|[Ff][Aa][Ll][Ss][Ee])$"),
    ("bigint", "^[+-]?[0-9]{1,18}$"),
    ("double", r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"),
    ("date", "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"),
    ("timestamp", r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])([T ]([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,6})?)?$"),
]
TEXT = "string"
_ALL = (1 << len(GRAMMARS)) - 1


def type_bits(c: Column) -> Column:
    """Bit k: the value fits the k-th grammar. A day beyond its month fits no date."""
    bits = [F.when(c.rlike(g), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, g) in enumerate(GRAMMARS)]
    real = F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd"))).isNotNull()
    dates = sum(1 << k for k, (name, _) in enumerate(GRAMMARS) if name in ("date", "timestamp"))
    found = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return F.when(found.bitwiseAND(F.lit(dates)) != 0, F.when(real, found).otherwise(found.bitwiseAND(F.lit(_ALL - dates)))).otherwise(found)


def column_type_bits(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(*by, column_name, bits, non_empty_values)``: mergeable by ``merge_type_bits``."""
    by = by or []
    columns = [c for c in rows.columns if c not in by]
    values = [F.col(f"`{c}`") for c in columns]
    seen = [v.isNotNull() & (v != F.lit("")) for v in values]
    aggs = [a for i, (v, s) in enumerate(zip(values, seen, strict=True))
            for a in (F.coalesce(F.bit_and(F.when(s, type_bits(v))), F.lit(_ALL)).alias(f"b{i}"), F.count(F.when(s, 1)).alias(f"n{i}"))]
    made = rows.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*aggs)
    return made.select(*[F.col(f"`{c}`") for c in by], F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"b{i}").alias("bits"), F.col(f"n{i}").alias("non_empty_values"))
        for i, c in enumerate(columns)])))


def merge_type_bits(parts: DataFrame) -> DataFrame:
    return parts.groupBy("column_name").agg(F.bit_and("bits").alias("bits"), F.sum("non_empty_values").cast("bigint").alias("non_empty_values"))


def inferred_types(bits: DataFrame) -> DataFrame:
    """``(column_name, inferred_type, non_empty_values)``: the most special type that all values fit."""
    name = F.lit(TEXT)
    for k, (t, _) in reversed(list(enumerate(GRAMMARS))):
        name = F.when(F.col("bits").bitwiseAND(F.lit(1 << k)) != 0, F.lit(t)).otherwise(name)
    return bits.select("column_name", F.when(F.col("non_empty_values") > 0, name).otherwise(F.lit(TEXT)).alias("inferred_type"), "non_empty_values")


def apply_types(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast to the types found for them (at most one a column, held by the caller); an empty value is null unless text."""
    return rows.select(*[
        F.col(f"`{c}`") if types.get(c, TEXT) == TEXT else F.nullif(F.col(f"`{c}`"), F.lit("")).try_cast(types[c]).alias(c)
        for c in rows.columns])
