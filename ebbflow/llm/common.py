"""Helpers shared by the training-data operators."""

from __future__ import annotations

import weakref
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.session import apply_base_conf, scratch_path, ship_package


def prepare(spark: SparkSession) -> None:
    """Session settings and code that every operator's tasks rely on.

    Rows with whole texts go to Python in small batches, so a worker holds few
    texts at a time however long they are.
    """
    apply_base_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    ship_package(spark)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder under the shared checkpoint root and reread.

    Cuts the lineage: a lost executor never sends work back past this table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    staged = spark.read.schema(df.schema).parquet(path)
    _STAGED[id(staged)] = path
    weakref.finalize(staged, _STAGED.pop, id(staged), None)
    return staged


def release(spark: SparkSession) -> None:
    """Let the driver see that finished jobs' shuffle files serve no one, so that executors drop them."""
    spark.sparkContext._jvm.System.gc()


_STAGED: dict[int, str] = {}


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        path = _STAGED.pop(id(df))
        sc = df.sparkSession.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` only, so clashing names of other columns do no harm;
    a null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id, m: int) -> int:
    """crc32 of the id's decimal text, modulo m (a null id counts as the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def crc_mod_col(col, m: int):
    """The same in Spark."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(m)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()]


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
