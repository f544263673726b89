"""Soft-membership mixing of domains to target weights (operator 3).

A classifier is fitted on a labelled table: the labels' classes are the
domains. It is a Bernoulli naive Bayes over the tokens (words, runs of
symbols, marks for capitals and repetition) that tell the classes apart best,
found by a likelihood-ratio test over the labelled texts. It gives every
document a posterior over the domains, so a document may belong to several.

Rates, how often a document is drawn, are fitted so that the expected tokens
of every domain, sum(rate * tokens * posterior), match the targets: least
squares by projected gradient, from a rate of one everywhere. A step is one
distributed aggregation of a number per domain; a document's own rate follows
from its posterior and the steps so far, so rates are never stored or sent.
Rates stay between ``min_rate``, 0 or more, and ``max_rate``; targets that
cannot be met within are met as nearly as least squares says.

With ``whole``, a domain's name, the documents most likely of that domain have a
rate of one, whatever share of the input they are. Its tokens, sum(tokens *
posterior), then set the other domains' goals by the ratios of the targets, and a
domain that has less than its goal has all that it has as goal. Only the other
documents' rates are fitted, to the other domains' goals.

``copies`` rounds a document's rate by a hash of its id, so that the expected
number of copies is the rate, and a rate of one or more is never rounded to 0.

``domain`` is an SQL expression on the labelled table that names a label's domain.

Results by case: a null or empty text has no tokens and the posterior of a
text without any of the chosen tokens. Repeated rows are rated each. Labels of
no domain (null) are left out; a document with several labels counts for each.
Without labels there is one domain, ``all``, and every rate is one; a ``whole``
that no label has is left out, and one without a target raises. Targets are
weights by domain name: missing ones are 0, those of unknown domains are left
out, and if none is left every rate is one. Extra columns are kept by ``mix``
and ignored by ``domain_rates``. An empty table gives no rows.
"""

from __future__ import annotations

import json
import operator
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.llm.common import id_and_text, prepare, record, stage, text_bytes

TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff\s]+")
MARKS = (b"<capitals>", b"<repeats>")


@dataclass
class Domains:
    names: list[str]
    tokens: dict[bytes, int]
    bias: np.ndarray  # log prior and the log chances of all tokens being absent
    gain: np.ndarray  # what a present token adds, a row per token

    def posteriors(self, found: list[list[int]]) -> np.ndarray:
        logs = np.tile(self.bias, (len(found), 1))
        for i, at in enumerate(found):
            if at:
                logs[i] += self.gain[at].sum(0)
        logs -= logs.max(1, keepdims=True, initial=-np.inf)
        p = np.exp(logs)
        return p / p.sum(1, keepdims=True)


def text_tokens(text: bytes) -> tuple[set[bytes], int]:
    """The distinct tokens of a text, and its number of words."""
    lower, words = text.lower(), text.split()
    tokens = set(TOKEN.findall(lower))
    if sum(map(bytes.isupper, words)) > 0.3 * len(words):
        tokens.add(MARKS[0])
    if sum(map(operator.eq, words, words[1:])) > 0.2 * len(words):
        tokens.add(MARKS[1])
    return tokens, len(words)


def labelled_sample(labels: DataFrame, domain: str, most: int) -> DataFrame:
    """At most ``most`` labelled rows, those whose ids hash lowest."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(domain).cast("string").alias("domain"))
    return known.where("doc_id IS NOT NULL AND domain IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(most)


def fit_domains(docs: DataFrame, labels: DataFrame, domain: str, most_labels: int = 20_000, most_tokens: int = 256,
                least_ratio: float = 30.0) -> Domains:
    """Fit on at most ``most_labels`` labelled rows (a documented bound)."""
    sample = stage(labelled_sample(labels, domain, most_labels), "mix-sample")
    texts = id_and_text(docs).join(F.broadcast(sample), "doc_id").select("domain", "text")  # most_labels short rows
    # Counted without the texts, which are then read once and not written.
    totals = {r.domain: r["count"] for r in texts.groupBy("domain").count().collect()}
    names = sorted(totals)
    if len(names) < 2:
        return Domains(names or ["all"], {}, np.zeros(1), np.zeros((0, 1)))
    schema = pa.schema([("domain", pa.string()), ("token", pa.binary())])

    def run(batches):
        for b in batches:
            pairs = [(d, t) for d, text in zip(b.column("domain").to_pylist(), text_bytes(b.column("text")), strict=True) for t in text_tokens(text)[0]]
            yield record(schema, domain=[p[0] for p in pairs], token=[p[1] for p in pairs])

    present = texts.mapInArrow(run, "domain string, token binary").groupBy("token").agg(
        *[F.sum((F.col("domain") == n).cast("long")).alias(f"n{k}") for k, n in enumerate(names)])
    every = sum(totals.values())
    seen = sum((F.col(f"n{k}") for k in range(len(names))), F.lit(0))

    def term(count, size, chance):
        return F.when(count > 0, count * F.log(count / (size * chance))).otherwise(0.0)

    ratio = sum((term(F.col(f"n{k}"), totals[n], seen / every) + term(totals[n] - F.col(f"n{k}"), totals[n], 1 - seen / every)
                 for k, n in enumerate(names)), F.lit(0.0)) * 2
    best = (present.where(seen >= 3).withColumn("ratio", ratio).where(F.col("ratio") >= least_ratio)
            .orderBy(F.desc("ratio"), "token").limit(most_tokens).collect())
    sizes = np.array([totals[n] for n in names], float)
    # A token's chance in a domain leans on its chance overall, so a domain with few labels says little.
    counts = np.array([[r[f"n{k}"] for k in range(len(names))] for r in best], float).reshape(len(best), len(names))
    chance = (counts + counts.sum(1, keepdims=True) / every + 0.01) / (sizes + 1.02)
    gain = np.log(chance) - np.log1p(-chance)
    bias = np.log(sizes / every) + np.log1p(-chance).sum(0)
    return Domains(names, {bytes(r.token): i for i, r in enumerate(best)}, bias, gain)


def with_domains(docs: DataFrame, domains: Domains, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with ``__n_tokens`` and ``__posterior``."""
    source = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = docs.columns if keep is None else keep
    source = source.select(*[F.col(f"`{c}`") for c in kept], "__text")
    schema = source.drop("__text").schema
    ddl = T.StructType([*schema, T.StructField("__n_tokens", T.LongType()), T.StructField("__posterior", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in batches:
            tokens = [text_tokens(t) for t in text_bytes(b.column(b.num_columns - 1))]
            found = [[domains.tokens[t] for t in s & domains.tokens.keys()] for s, _ in tokens]
            columns = [*b.columns[:-1], pa.array([n for _, n in tokens], pa.int64()),
                       pa.array(list(domains.posteriors(found)), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*b.schema.names[:-1], "__n_tokens", "__posterior"])

    return source.mapInArrow(run, ddl)


def rate_column(steps: list[list[float]], domains: int, min_rate: float = 0.0, max_rate: float = float("inf"),
                whole: int | None = None) -> Column:
    """A document's rate after the steps, each a number per domain; one if ``whole`` is its likeliest domain."""
    if not steps:
        return F.lit(1.0)
    moves = F.from_json(F.lit(json.dumps(steps)), "array<array<double>>")

    def moved(rate, step):
        along = sum((F.col("__posterior")[k] * step[k] for k in range(domains)), F.lit(0.0))
        return F.least(F.lit(float(max_rate)), F.greatest(F.lit(float(min_rate)), rate - along))

    rate = F.aggregate(moves, F.lit(1.0), moved)
    return rate if whole is None else F.when(_likeliest(whole), F.lit(1.0)).otherwise(rate)


def _likeliest(domain: int) -> Column:
    return F.col("__posterior")[domain] >= F.array_max("__posterior")


def fit_rates(soft: DataFrame, names: list[str], targets: dict[str, float], total_tokens: float | None = None,
              most_steps: int = 60, tolerance: float = 1e-4, whole: str | None = None, **bounds: float) -> list[list[float]]:
    """Steps of the projected gradient; ``soft`` comes from ``with_domains``.
    With ``whole`` the totals follow from that domain's.

    Least squares of the domains' token totals, whitened by how the documents'
    tokens move them (the domains' Gram matrix), so that small domains converge
    as fast as large ones and a step of one is the longest that is safe.
    """
    k = len(names)
    weights = np.array([max(0.0, float(targets.get(n, 0.0))) for n in names])
    at = _place(names, whole)
    if at is not None and (not weights[at] or total_tokens is not None):
        raise ValueError("whole needs a target, and sets the totals itself")
    fitted = np.array([i != at for i in range(k)], float)
    p = [F.col("__posterior")[i] for i in range(k)]
    moved = F.col("__n_tokens") if at is None else F.when(_likeliest(at), 0).otherwise(F.col("__n_tokens"))
    sums = soft.agg(F.coalesce(F.sum("__n_tokens"), F.lit(0)), *[F.coalesce(F.sum(F.col("__n_tokens") * a), F.lit(0.0)) for a in p],
                    *[F.coalesce(F.sum(moved * a * b), F.lit(0.0)) for a in p for b in p]).first()
    tokens, have = float(sums[0]), np.array(sums[1:k + 1], float)
    if not tokens or not weights.sum():
        return []
    gram = np.array(sums[k + 1:], float).reshape(k, k) * np.outer(fitted, fitted)
    if at is None:
        goal = weights / weights.sum() * (tokens if total_tokens is None else total_tokens)
    else:
        goal = np.minimum(have, have[at] * weights / weights[at])
    whiten = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    steps: list[list[float]] = []
    last = None
    for _ in range(most_steps):
        rate = rate_column(steps, k, whole=at, **bounds)
        now = np.array(soft.select("__n_tokens", "__posterior", rate.alias("rate")).agg(
            *[F.coalesce(F.sum(F.col("rate") * F.col("__n_tokens") * a), F.lit(0.0)) for a in p]).first(), float)
        if np.abs((now - goal) * fitted).max() <= tolerance * goal.sum() or last is not None and np.abs(now - last).max() <= 0.01 * tolerance * goal.sum():
            break
        last = now
        steps.append([float(x) for x in whiten @ ((now - goal) * fitted)])
    return steps


def domain_rates(docs: DataFrame, labels: DataFrame, domain: str, targets: dict[str, float], id_col: str = "doc_id",
                 text_col: str = "text", **options) -> tuple[DataFrame, list[str], list[list[float]]]:
    """``(doc_id, n_tokens, posterior, rate, copies)`` per row, the domains' names and the steps."""
    prepare(docs.sparkSession)
    source = id_and_text(docs, id_col, text_col)
    domains = fit_domains(source, labels, domain)
    soft = stage(with_domains(source, domains, ["doc_id"]), "mix-posteriors")
    steps = fit_rates(soft, domains.names, targets, **options)
    rated = soft.withColumn("rate", rate_column(steps, len(domains.names), **_bounds(options, domains.names)))
    rated = rated.withColumn("copies", copies("rate"))
    return rated.withColumnsRenamed({"__n_tokens": "n_tokens", "__posterior": "posterior"}), domains.names, steps


def _place(names: list[str], whole: str | None) -> int | None:
    return names.index(whole) if whole in names else None


def _bounds(options: dict, names: list[str]) -> dict:
    return {k: v for k, v in options.items() if k in ("min_rate", "max_rate")} | {"whole": _place(names, options.get("whole"))}


def copies(rate: str) -> Column:
    """The rate rounded down or up by a hash of the id."""
    chance = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(F.col(rate) + chance).cast("long")


def mix(docs: DataFrame, labels: DataFrame, domain: str, targets: dict[str, float], repeat: bool = True, **options) -> DataFrame:
    """The rows of ``docs`` as often as their rates say (at most once without ``repeat``), columns as they are."""
    prepare(docs.sparkSession)
    # The whole row goes along in one column, so no name of its columns clashes, and each text is classified once.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    domains = fit_domains(docs, labels, domain)
    soft = stage(with_domains(rows, domains, ["row", "doc_id"]), "mix-posteriors")
    steps = fit_rates(soft, domains.names, targets, **options)
    rated = (soft.withColumn("rate", rate_column(steps, len(domains.names), **_bounds(options, domains.names)))
             .withColumn("copies", copies("rate")).where("copies > 0"))
    if repeat:
        rated = rated.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rated.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
