"""Exact deduplication by a stateful stream (operator 6).

Texts are equal when identical after lower-casing A-Z. One narrow pass gives
every row a locator (run, task and row number) and the SHA-256 digest of its
normalised text. These narrow rows are streamed through a keyed state on disk
(RocksDB) that never expires: per digest it retains the stable identifier of
the row that stays, its content locator and the number of rows seen. A later
run over new rows with the same checkpoint goes on from that state.

A hit, a digest seen more than once, is checked on full bytes against the
content at the locator; rows that share a digest but not their bytes are
grouped again by the bytes themselves.

Of equal texts the largest ``doc_id`` stays, and of its repeated rows the
last located. Results by case: null text is empty, and empty texts equal each
other. A null id is below all others. Repeated rows each get a result row,
one of them kept. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.llm.common import id_and_text, prepare, record, release, stage, text_bytes
from ebbflow.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
COMPARED = 256  # rows of a group that one task compares with the content that stays
_PREALLOCATE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("locator", pa.int64()), ("digest", pa.binary()), ("text_sha256", pa.string())])
_DIGESTS_DDL = "doc_id long, locator long, digest binary, text_sha256 string"
_LOCATED = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("content", pa.binary())])


def normalised(text: bytes) -> bytes:
    """A-Z in lower case; all other bytes as they are."""
    return text.lower()


def digests(docs: DataFrame, digest_bytes: int = 32, run_number: int = 0) -> DataFrame:
    """``run_number`` tells the rows of several runs on one state apart; it is part of the locator."""
    def run(batches):
        at = (run_number << 54) | (TaskContext.get().partitionId() << 33)
        for b in batches:
            sha = [hashlib.sha256(normalised(t)) for t in text_bytes(b.column("text"))]
            yield record(_DIGESTS, doc_id=b.column("doc_id"), locator=range(at, at + len(sha)),
                         digest=[h.digest()[:digest_bytes] for h in sha], text_sha256=[h.hexdigest() for h in sha])
            at += len(sha)

    return docs.mapInArrow(run, _DIGESTS_DDL)


def update_state(spark: SparkSession, arrivals: str, state: str, changes: str, files_per_trigger: int = 1000) -> None:
    """Stream the files of ``arrivals`` not seen before into the keyed state.

    Every micro-batch writes the digests that it changed to its own folder of
    ``changes``; replaying a batch overwrites that folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")

    settings = {_PROVIDER: ROCKSDB, _PREALLOCATE: "false"}  # many small stores: no space ahead of need
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = (spark.readStream.schema(_DIGESTS_DDL).option("maxFilesPerTrigger", files_per_trigger).parquet(arrivals)
                .groupBy("digest")
                .agg(F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "locator", "doc_id")).alias("stays"),
                     F.count(F.lit(1)).alias("group_size")))
        query = (rows.writeStream.outputMode("update").option("checkpointLocation", state)
                 .trigger(availableNow=True).foreachBatch(write).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_table(spark: SparkSession, changes: str) -> DataFrame:
    """The state's rows as they are now: identifiers and counts only grow."""
    rows = spark.read.schema("digest binary, stays struct<id: long, locator: long, doc_id: long>, group_size long").parquet(f"{changes}/batch=*")
    return rows.groupBy("digest").agg(F.max("stays").alias("stays"), F.max("group_size").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    ``digest_bytes`` shortens the state's key; the result is the same at any
    length, since hits are checked on their bytes.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = scratch_path(spark, "exact-dedup")
    source = id_and_text(docs, id_col, text_col)
    digests(source, digest_bytes).write.parquet(f"{base}/arrivals")
    rows = spark.read.schema(_DIGESTS_DDL).parquet(f"{base}/arrivals")
    if rows.isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.col("locator").alias("group_size"),
                           F.lit(False).alias("kept"), "text_sha256")
    release(spark)  # of the write, before the stream's jobs
    update_state(spark, f"{base}/arrivals", f"{base}/state", f"{base}/changes")
    release(spark)
    groups = stage(state_table(spark, f"{base}/changes"), "exact-dedup-groups")
    found = rows.join(groups, "digest").select(
        "doc_id", "locator", "digest", "text_sha256", "stays", "group_size")

    odd = stage(differing(source, rows, groups), "exact-dedup-differing")
    if not odd.isEmpty():
        again = regrouped(source, rows, odd)
        found = found.join(odd.select("digest").distinct(), "digest", "left_anti").unionByName(again)
    return found.select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
                        (F.col("locator") == F.col("stays.locator")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, columns as they are."""
    found = stage(exact_dedup(docs), "exact-dedup-found")
    kept = found.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha256"))
    # The whole row goes along in one column, so no name of its columns clashes.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for b in batches:
            sha = [hashlib.sha256(normalised(t)).hexdigest() for t in text_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(sha, pa.string())], ["row", "doc_id", "sha256"])

    rows = rows.mapInArrow(run, T.StructType([rows.schema["row"], rows.schema["doc_id"], T.StructField("sha256", T.StringType())]))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("sha256") == F.col("kept_sha256")), "left_semi")
    if not found.groupBy("doc_id", "text_sha256").count().where("count > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "sha256"])  # a row that is there several times stays once
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _contents(source: DataFrame) -> DataFrame:
    """``(doc_id, text_sha256, content)``: normalised texts, for reading back by identifier."""
    def run(batches):
        for b in batches:
            content = [normalised(t) for t in text_bytes(b.column("text"))]
            yield record(_LOCATED, doc_id=b.column("doc_id"), content=content,
                         text_sha256=[hashlib.sha256(c).hexdigest() for c in content])

    return source.mapInArrow(run, "doc_id long, text_sha256 string, content binary")


def differing(source: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``(digest)`` of hits whose full bytes differ from those of the row that stays.

    Only rows of groups take part: their texts are read back by identifier.
    """
    # A repeated identifier reads back as each of its texts, so the digest of the whole text picks the right one.
    hits = rows.join(groups.where("group_size > 1"), "digest").select("doc_id", "text_sha256", "digest", F.col("stays.locator").alias("stays"), "locator",
                                                                       "group_size")
    hits = hits.groupBy("doc_id", "text_sha256", "digest", "stays", "group_size").agg(F.max(F.col("locator") == F.col("stays")).alias("is_kept"))
    contents = _contents(source).withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    hits = hits.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    read = hits.join(contents, ["doc_id", "text_sha256"]).select("digest", "is_kept", "content", "group_size", "doc_id")
    read = stage(read, "exact-dedup-contents")
    # A large group is compared by several tasks, each with its own copy of the content that stays.
    parts = F.ceil(F.col("group_size") / COMPARED).cast("long")
    kept = read.where("is_kept").select("digest", F.col("content").alias("kept_content"), "group_size").dropDuplicates(["digest"])
    kept = kept.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("group_size")
    read = read.withColumn("part", F.pmod(F.xxhash64("doc_id"), parts))
    return read.join(kept, ["digest", "part"]).where(F.col("content") != F.col("kept_content")).select("digest")


def regrouped(source: DataFrame, rows: DataFrame, odd: DataFrame) -> DataFrame:
    """Rows of digests that several texts share, grouped by their bytes."""
    shared = rows.join(odd.select("digest").distinct(), "digest")
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    contents = _contents(source).withColumn("key", key).drop("doc_id").dropDuplicates(["key", "text_sha256"])
    read = shared.withColumn("key", key).join(contents, ["key", "text_sha256"]).drop("key")
    stays = read.groupBy("content").agg(
        F.max(F.struct(key.alias("id"), "locator", "doc_id")).alias("stays"), F.count(F.lit(1)).alias("group_size"))
    return read.join(stays, "content").select("doc_id", "locator", "digest", "text_sha256", "stays", "group_size")
