"""Incremental marts: rows merged by key, rewriting only the partitions they touch.

A full rebuild of a mart loses what left the retention window and rewrites
everything. Here new and changed rows replace those of the same key, ``kept``
columns (``inserted_at``, ``is_resolved``) stay those of the first version, and
rows that say the same as before are no change. Partitions without a change are
neither read beyond their key columns nor written, so their files stay as they
are. A key that moved to another partition leaves its old one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.session import scratch_path
from ebbflow.sinks import parquet as W


def upsert(spark: SparkSession, rows: DataFrame, path: str, keys: list[str], partition_col: str, compare: list[str],
           kept: tuple[str, ...] = ("inserted_at",), cluster_cols: tuple[str, ...] = ()) -> int:
    """Merge ``rows`` into the mart at ``path``; returns the number of partitions rewritten.

    ``compare``: columns that tell a change (others, such as time stamps, follow when one does). Rows that repeat a key count once, the one greatest by all columns.
    """
    columns = rows.columns
    others = [c for c in columns if c not in keys]
    rows = rows.groupBy(*keys).agg(F.max(F.struct(*others)).alias("row")).select(*keys, *[F.col(f"row.{c}") for c in others]).select(*columns)
    try:
        old = W.read_partitioned(spark, path, {partition_col: "date"}).select(*columns)
    except AnalysisException:  # no mart yet
        _write(rows, path, partition_col, cluster_cols)
        return rows.select(partition_col).distinct().count()

    def same(names):
        cond = F.lit(True)
        for c in names:
            cond = cond & F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
        return cond

    there = old.select(*keys, *[c for c in compare if c not in keys], F.col(partition_col).alias("__was"), F.lit(True).alias("__there"))
    met = rows.alias("n").join(there.alias("o"), same(keys), "left")
    changed = met.where(F.col("__there").isNull() | ~same(compare)).select("n.*", "__was", "__there")
    staged = scratch_path(spark, "upsert")
    changed.write.parquet(staged)  # read twice: for the partitions, and merged
    changed = spark.read.schema(changed.schema).parquet(staged)
    # Partition values (dates of a mart), not rows.
    touched = {r[0] for r in changed.select(partition_col).union(changed.where("__there").select("__was")).distinct().collect()}
    if not touched:
        return 0
    of_touched = F.col(partition_col).isin([v for v in touched if v is not None])
    if None in touched:
        of_touched = of_touched | F.col(partition_col).isNull()
    before = old.where(of_touched)
    new = changed.drop("__was", "__there").withColumn("__new", F.lit(True))
    merged = before.alias("o").join(new.alias("n"), same(keys), "full_outer").select(*[
        (F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in kept else F.when(F.col("__new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))).alias(c)
        for c in columns])
    # The merged rows are written aside first: what is replaced is also what is read.
    aside = scratch_path(spark, "upsert-merged")
    merged.write.parquet(aside)
    merged = spark.read.schema(merged.schema).parquet(aside)
    left = {r[0] for r in merged.select(partition_col).distinct().collect()}
    _write(merged, path, partition_col, cluster_cols)
    _drop_partitions(spark, path, partition_col, [v for v in touched if v not in left])
    return len(touched)


def _write(rows: DataFrame, path: str, partition_col: str, cluster_cols: tuple[str, ...]) -> None:
    if cluster_cols:
        W.write_clustered(rows, path, partition_col, list(cluster_cols))
    else:
        W.write_partitioned(rows, path, [partition_col])


def _drop_partitions(spark: SparkSession, path: str, partition_col: str, values: list) -> None:
    """Folders of partitions that a merge left without rows."""
    jvm = spark.sparkContext._jvm
    for v in values:
        name = "__HIVE_DEFAULT_PARTITION__" if v is None else v
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_col}={name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
