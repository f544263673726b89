"""Rule routing of processed events to per-tenant x per-event-type tables.

A row goes to every table whose rule matches exactly (case-sensitive) on the
rule's filter column and whose tenant list is NULL (all tenants) or contains
the row's tenant. Routing is non-exclusive: a row can reach several tables.

Plan: for each column that rules filter on, the row looks up its value in the
rules of that column, grouped by value (one left equi-join each; rules are a
literal relation of known size, so Spark broadcasts them by its own threshold
and shuffles beyond it). Only then the rules found, less those not allowed for
the tenant, are exploded, so a wide row is repeated once for each table that it
goes to. Names added on the way are never those of source columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow import config as C
from ebbflow.functions import columns as X
from ebbflow.functions.names import fresh_names

class RuleSet:
    """Routing rules held as configuration, materialised as a small DataFrame."""

    def __init__(self, rules=C.DEFAULT_RULES):
        self.rules = [(s, c, v, list(a) if a is not None else None) for s, c, v, a in rules]

    @classmethod
    def from_frame(cls, rules: DataFrame) -> RuleSet:
        """Rules kept as data: ``suffix, filter_column, filter_value, allowed``
        (an array of tenants, NULL for all), e.g. a Parquet or JSON file. They
        are configuration, so they are read on the driver."""
        rows = rules.select("suffix", "filter_column", "filter_value", "allowed").collect()
        bad = [r for r in rows if not r["suffix"] or not r["filter_column"] or r["filter_value"] is None]
        if bad:
            raise ValueError(f"rules without a suffix, column or value: {bad}")
        return cls([tuple(r) for r in rows])

    @property
    def filter_columns(self) -> list[str]:
        return sorted({c for _, c, _, _ in self.rules})

    @property
    def global_suffixes(self) -> list[str]:
        return [s for s, _, _, a in self.rules if a is None]

    def frame(self, spark: SparkSession) -> DataFrame:
        """Rules as an inline VALUES relation: one small local table, parsed
        once, no Python-side scan."""
        values = ", ".join(f"({_text(s)}, {_text(c)}, {_text(v)}, {_texts(a)})" for s, c, v, a in self.rules)
        return spark.sql(f"SELECT * FROM VALUES {values} AS rules(suffix, filter_column, filter_value, allowed)")

    def by_value(self, spark: SparkSession, column: str) -> DataFrame:
        """``(value, found)``: the rules of a filter column, in an array by value (an inline relation as well)."""
        found: dict[str, list[str]] = {}
        for s, c, v, a in self.rules:
            if c == column:
                found.setdefault(v, []).append(f"named_struct('suffix', {_text(s)}, 'allowed', {_texts(a)})")
        values = ", ".join(f"({_text(v)}, array({', '.join(rules)}))" for v, rules in found.items())
        return spark.sql(f"SELECT * FROM VALUES {values} AS rules(value, found)")


def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts(a: list[str] | None) -> str:
    return "CAST(NULL AS ARRAY<STRING>)" if a is None else "CAST(array(" + ", ".join(map(_text, a)) + ") AS ARRAY<STRING>)"


def routed_rows(processed: DataFrame, rules: RuleSet, tenant_col: str = "prefix",
                normalize_activity: bool = False, route_empty_tenant: bool = True, table_col: str = "table_name") -> DataFrame:
    """Processed rows x matching rules, with the table's name in ``table_col``.

    Defaults reproduce the original behaviour: exact activity match, and rows
    whose file name yields the empty tenant ``''`` are routed too (tables named
    ``_<suffix>``); ``route_empty_tenant=False`` leaves them unrouted.
    """
    spark = processed.sparkSession
    source = [c for c in processed.columns if c != table_col]
    tenant = F.col(f"`{tenant_col}`")
    keep = tenant.isNotNull()
    if not route_empty_tenant:
        keep = keep & (tenant != F.lit(""))
    out, matches = processed.where(keep), []
    for c in rules.filter_columns:
        # The activity filter is trim/case-insensitive while routing is exact;
        # normalize_activity=True routes on the normalised value instead.
        value = X.normalized_activity(f"`{c}`") if normalize_activity and c == "activity_kind" else F.col(f"`{c}`").cast("string")
        key, found = fresh_names(out.columns, "__rule_value", "__rules_found")
        out = out.join(rules.by_value(spark, c).toDF(key, found), value == F.col(key), "left")
        matches.append(F.coalesce(F.col(found), F.expr("CAST(array() AS ARRAY<STRUCT<suffix: STRING, allowed: ARRAY<STRING>>>)")))
    if not matches:
        return processed.where("false").select(*[F.col(f"`{c}`") for c in source], F.lit("").alias(table_col))
    fits = F.filter(F.concat(*matches), lambda r: r["allowed"].isNull() | F.array_contains(r["allowed"], tenant))
    tables = F.transform(fits, lambda r: X.table_name(tenant, r["suffix"]))
    return out.select(*[F.col(f"`{c}`") for c in source], F.explode(tables).alias(table_col))


def route_events(processed: DataFrame, rules: RuleSet | None = None,
                 excluded=C.ROUTED_EXCLUDED_COLUMNS, normalize_activity: bool = False,
                 route_empty_tenant: bool = True) -> DataFrame:
    """Routed table rows: processed columns minus the excluded ones, plus ``table_name``."""
    rules = rules or RuleSet()
    r = routed_rows(processed, rules, "prefix", normalize_activity, route_empty_tenant)
    keep = [c for c in processed.columns if c not in set(excluded) and c != "table_name"]
    return r.select(*[F.col(f"`{c}`") for c in keep], "table_name")


def permitted_tables(tenants: DataFrame, rules: RuleSet, tenant_col: str = "prefix") -> DataFrame:
    """Every (tenant, rule) pair the rules permit for the tenants present.

    Built without a join of two data sides: each tenant row (one per distinct
    tenant) expands the literal list of rule suffixes, and a broadcast equi-join
    on the suffix keeps the pairs whose allow-list is NULL or names the tenant.
    Output is bounded by (#tenants x #rules), the size of the coverage report.
    """
    spark = tenants.sparkSession
    suffixes = sorted({s for s, _, _, _ in rules.rules})
    t = tenants.select(F.col(tenant_col).alias("prefix")).where(F.col("prefix").isNotNull())
    pairs = t.select("prefix", F.explode(F.array(*[F.lit(x) for x in suffixes])).alias("suffix"))
    rf = rules.frame(spark).select("suffix", "allowed")
    ok = pairs.join(rf, "suffix").where(F.col("allowed").isNull()
                                         | F.array_contains("allowed", F.col("prefix")))
    return ok.select("prefix", "suffix").distinct()


def routing_coverage(processed: DataFrame, rules: RuleSet | None = None,
                     tenant_col: str = "prefix", normalize_activity: bool = False,
                     route_empty_tenant: bool = True) -> DataFrame:
    """Per permitted (tenant, rule): rows routed and ``written`` / ``empty``.

    The data is first reduced to counts per (tenant, filter values): one
    map-side-combined aggregate whose output is small at any input size
    (tenants x distinct event kinds). Routing and the tenant list are computed
    from that aggregate, so the rules are never joined against raw rows here.

    Output: prefix, suffix, table_name, routed_rows, status. The input is read
    once: every combination of values meets every rule, and adds its count to
    the rules that it matches.
    """
    rules = rules or RuleSet()
    tenant = F.col(f"`{tenant_col}`")
    keep = tenant.isNotNull()
    if not route_empty_tenant:
        keep = keep & (tenant != F.lit(""))
    # Private names from here on: the tenant, each filter column's value, and the count.
    values = {c: f"v{i}" for i, c in enumerate(rules.filter_columns)}
    own = {c: X.normalized_activity(f"`{c}`") if normalize_activity and c == "activity_kind" else F.col(f"`{c}`").cast("string")
           for c in rules.filter_columns}
    combos = (processed.where(keep).select(tenant.alias("prefix"), *[own[c].alias(v) for c, v in values.items()])
              .groupBy("prefix", *values.values()).agg(F.count(F.lit(1)).alias("n")))
    suffixes = sorted({s for s, _, _, _ in rules.rules})
    pairs = combos.withColumn("suffix", F.explode(F.array(*[F.lit(x) for x in suffixes])))
    met = pairs.join(rules.frame(processed.sparkSession), "suffix").where(
        F.col("allowed").isNull() | F.array_contains(F.col("allowed"), F.col("prefix")))
    value = F.lit(None).cast("string")
    for c, v in values.items():
        value = F.when(F.col("filter_column") == c, F.col(v)).otherwise(value)
    cov = met.groupBy("prefix", "suffix").agg(F.sum(F.when(value == F.col("filter_value"), F.col("n"))).alias("routed_rows"))
    rows = F.coalesce(F.col("routed_rows"), F.lit(0)).cast("bigint")
    return cov.select(
        "prefix", "suffix",
        X.table_name("prefix", "suffix").alias("table_name"),
        rows.alias("routed_rows"),
        F.when(rows > 0, F.lit("written")).otherwise(F.lit("empty")).alias("status"),
    )


def no_tenant_rows(processed: DataFrame, tenant_col: str = "prefix", reason_col: str = "reason") -> DataFrame:
    """Rows whose file name has no tenant, with the reason they are set aside.

    A source column named ``reason_col`` is kept as ``<reason_col>_2`` (or the next free number).
    """
    tenant = F.col(f"`{tenant_col}`")
    names, k = {c.lower() for c in processed.columns}, 2
    while f"{reason_col}_{k}".lower() in names:
        k += 1
    columns = [F.col(f"`{c}`").alias(f"{c}_{k}" if c.lower() == reason_col.lower() else c) for c in processed.columns]
    return processed.where(tenant.isNull() | (tenant == F.lit(""))).select(*columns, F.lit("NO_TENANT").alias(reason_col))


def unrouted_rows(processed: DataFrame, rules: RuleSet | None = None,
                  tenant_col: str = "prefix", normalize_activity: bool = False,
                  route_empty_tenant: bool = True) -> DataFrame:
    """Rows with a tenant that no rule routes anywhere (e.g. an accepted
    activity kind without a rule), counted from the same small pre-aggregate.
    Output: one row, ``rows_unrouted``."""
    rules = rules or RuleSet()
    keys = [tenant_col, *rules.filter_columns]
    tenant = F.col(f"`{tenant_col}`")
    combos = processed.where(tenant.isNotNull() if route_empty_tenant else tenant != F.lit("")).select(*[F.col(f"`{k}`") for k in keys])
    n, table = fresh_names(keys, "__n", "__table")
    combos = combos.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(n))
    hit = routed_rows(combos, rules, tenant_col, normalize_activity, route_empty_tenant, table).select(*[F.col(f"`{k}`") for k in keys]).distinct()
    cond = [combos[f"`{k}`"].eqNullSafe(hit[f"`{k}`"]) for k in keys]
    miss = combos.join(hit, cond, "left_anti")
    return miss.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("rows_unrouted"))
