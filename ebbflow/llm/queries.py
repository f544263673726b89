"""Registered queries of the training-data operators, with their SQL where SQL can express them.

Every query reads its whole table through its operator with production
parameters and derives the contract's columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.llm import (exact_dedup, jaccard_join, language_model, mixing, multi_index, packing, quality, ranked_search, repeated_text,
                         secret_scan, sharding, square_runs, token_counts)
from ebbflow.llm.common import prepare, table

WORD_BPE = tokenizer_path("word_bpe_49k.json")
SHARDS = [f"shard-{i:03d}" for i in range(64)]
#: A domain is a class of the labelled table; targets are shares of all tokens.
LABEL_DOMAIN = "concat('quality', quality, '_toxic', toxic)"
TARGETS = {"quality1_toxic0": 0.95, "quality1_toxic1": 0.03, "quality0_toxic0": 0.02}


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "tier", "step_id")


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's posterior over the label classes, its rate and its copies."""
    rates, names, _ = mixing.domain_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), LABEL_DOMAIN, TARGETS)
    return rates.select("doc_id", "n_tokens", *[F.col("posterior")[k].alias(f"p_{n}") for k, n in enumerate(names)], "rate", "copies")


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), words=5, percent=80).drop("class_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_repeated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeated_text.remove_repeated(table(spark, sf_dir, "documents"), length=50)
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return sharding.assign_shards(docs, "doc_id", SHARDS)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), WORD_BPE)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.summary(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op12_square_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document gets a repeated stretch before its runs are caught."""
    docs = square_runs.with_repeated_stretches(table(spark, sf_dir, "documents"))
    return square_runs.summary(square_runs.periodic_runs(docs, least_length=6, exponent=4))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_multi_index, op3_mixing, op4_language_model, op5_jaccard_join, op6_exact_dedup,
                            op7_repeated_text, op8_sharding, op9_quality, op10_token_counts,
                            op11_secret_scan, op12_square_runs, op13_ranked_search)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def oracle_sql() -> dict[str, str]:
    words = f"[w FOR w IN string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+') IF w <> '']"
    owner = ",".join(map(str, sharding.fill_table(SHARDS)))
    return {
        "op5_jaccard_join": f"""
            WITH RECURSIVE d AS (SELECT doc_id, {words} AS w FROM documents),
                 s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END AS shingle
                       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
                 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
                 pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle)
                           WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
                 links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                           WHERE 100 * common >= 80 * (x.n + y.n - common)),
                 reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
                 least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
            SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least.component_id
            FROM d LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)""",
        "op6_exact_dedup": f"""
            WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
                 g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
            SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
            FROM t JOIN g USING (norm)""",
        "op13_ranked_search": f"""
            WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS t FROM documents),
                 g AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
                 q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
                 o AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d),
                 f AS (SELECT doc_id, n, term, count(*) AS tf FROM o WHERE term IN (SELECT term FROM q) GROUP BY ALL),
                 w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, g GROUP BY term),
                 s AS (SELECT item_id, doc_id,
                              sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
                       FROM q JOIN f USING (term) JOIN w USING (term), g GROUP BY item_id, doc_id),
                 r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
            SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10""",
        "op8_sharding": f"""
            WITH t AS (SELECT doc_id, lang, source, n_chars,
                              ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT % {sharding.TABLE_SIZE} AS slot FROM documents)
            SELECT doc_id, lang, source, n_chars, slot::INTEGER AS slot,
                   'shard-' || lpad(([{owner}])[slot + 1]::VARCHAR, 3, '0') AS shard FROM t""",
    }
