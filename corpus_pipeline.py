"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet under the shared checkpoint folder and rereads it as the
next stage's ``docs``. All stages but the last return the columns of
``documents``.

Results by case: null ids, null and empty texts, repeated rows and extra
columns go by the rules of each stage's operator; an empty table stays empty
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.names import fresh_names
from ebbflow.llm import exact_dedup, jaccard_join, mixing, packing, quality
from ebbflow.llm.common import stage, table
from ebbflow.llm.queries import LABEL_DOMAIN, TARGETS, WORD_BPE

WANTED = "quality1_toxic0"  # the class that mixing keeps whole


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links join, the one with the smallest id; rows of one id stay together."""
    found = jaccard_join.jaccard_components(docs)
    (kept,) = fresh_names(docs.columns, "kept_id")
    found = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(kept)).distinct()
    return docs.join(found, docs.doc_id.eqNullSafe(F.col(kept)), "left_semi")


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at rates that move the label classes to their targets.

    Rates are at most one and no document is repeated: documents most likely of
    the wanted class all stay, and documents of classes above their target, as a
    ratio to the wanted class, go as their rates say.
    """
    return mixing.mix(docs, table(spark, sf_dir, "labels"), LABEL_DOMAIN, TARGETS, repeat=False, max_rate=1.0, whole=WANTED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    pieces = packing.pack_documents(docs, WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "tier", "step_id")


STAGES = [("quality", reject_poor), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies),
          ("mixing", mix_domains), ("packing", pack)]

#: The classifier, the rates and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
