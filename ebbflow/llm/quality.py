"""Quality scores by random Fourier features (operator 9).

Every text becomes a vector of statistics (``text_features``; no identifier,
source, language or label among them), standardised by the training rows'
means and deviations. Random Fourier features approximate a Gaussian kernel
on it. A ridge regression on the label, classes weighted alike, is fitted from
normal equations that tasks sum over their rows, by fold: leaving one fold out
of the sums gives the scores that choose the ridge and calibrate, so no row is
judged by a fit that saw it. Isotonic regression (pooled from a histogram of
these scores of fixed size) turns the fit's score into the chance of label 1.

Results by case: a null or empty text has the statistics of an empty text and
is scored. Repeated rows are scored each. A row with several labels counts as
1 if their mean is at least 0.5; null labels are ignored. With no training
rows, or of one class only, every score is their mean label, 0.5 if there are
none. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import crc_mod_col, id_and_text, prepare, record, stage, text_bytes
from ebbflow.llm.text_features import NAMES, statistics

FOLDS, BINS = 3, 2048
RIDGES = [1e-5, 1e-4, 1e-3, 1e-2, 1e-1]
_FEATURES = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float32()))])


@dataclass
class Scorer:
    """A fitted classifier: statistics in, chance of label 1 out."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # random frequencies, a column per feature
    phases: np.ndarray
    beta: np.ndarray | None  # None: every score is ``rate``
    knots: np.ndarray
    chances: np.ndarray
    rate: float

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        waves = np.cos(z @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([waves, z, np.ones(len(z))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.beta is None:
            return np.full(len(x), self.rate)
        raw = self.features(x) @ self.beta
        # A thousandth of the uncalibrated score keeps the order within a calibrated step.
        return 0.999 * np.interp(raw, self.knots, self.chances) + 0.001 * np.clip(raw, 0, 1)


def text_statistics(source: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield record(_FEATURES, doc_id=b.column("doc_id"), x=[statistics(t) for t in text_bytes(b.column("text"))])

    return source.mapInArrow(run, "doc_id long, x array<float>")


def _stack(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).astype(float)


def isotonic(bins: np.ndarray, n: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and non-decreasing means of pooled adjacent violators; bins ascending."""
    blocks: list[list[float]] = []
    for at, count, one in zip(bins, n, ones, strict=True):
        blocks.append([at * count, count, one])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(train: DataFrame, waves: int = 256, seed: int = 5) -> Scorer:
    """``train``: ``(doc_id, x, y)``, y 0 or 1, staged."""
    d = len(NAMES)
    facts = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0)),
                      F.array(*[F.avg(F.col("x")[i]) for i in range(d)]), F.array(*[F.stddev_pop(F.col("x")[i]) for i in range(d)])).first()
    n, ones = facts[0], facts[1]
    rng = np.random.default_rng(seed)
    blank = Scorer(np.zeros(d), np.ones(d), rng.normal(0, 1 / np.sqrt(d), (d, waves)), rng.uniform(0, 2 * np.pi, waves),
                   None, np.zeros(1), np.zeros(1), ones / n if n else 0.5)
    if not 0 < ones < n:
        return blank
    blank.centre, blank.scale = np.array(facts[2]), np.maximum(np.array(facts[3]), 1e-6)
    weight = np.array([0.5 / (n - ones), 0.5 / ones])
    size = waves + d + 1

    def partial(batches):
        sums = np.zeros((FOLDS, size + 1, size + 1))
        for b in batches:
            y, fold = b.column("y").to_numpy(), b.column("fold").to_numpy()
            z = np.column_stack([blank.features(_stack(b.column("x"))), y])
            for f in range(FOLDS):
                zf = z[fold == f]
                sums[f] += zf.T @ (zf * weight[y[fold == f]][:, None])
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"fold": list(range(FOLDS)), "part": [part] * FOLDS, "sums": [s.tobytes() for s in sums]},
                                         schema=pa.schema([("fold", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())]))

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s) for s in rows["sums"])
        return pd.DataFrame({"fold": rows["fold"][:1], "part": rows["part"][:1], "sums": [total.tobytes()]})

    ddl = "fold int, part int, sums binary"
    folded = train.withColumn("fold", _fold())
    parts = folded.mapInArrow(partial, ddl)
    # Sums of sums, so no task holds the matrices of more than a part of the tasks.
    parts = parts.groupBy("fold", F.expr("part % 16")).applyInPandas(add, ddl).groupBy("fold").applyInPandas(add, ddl)
    sums = {r.fold: np.frombuffer(r.sums).reshape(size + 1, size + 1) for r in parts.collect()}
    total = sum(sums.values())

    def solve(m, ridge):
        penalty = ridge * np.eye(size)
        penalty[-1, -1] = 1e-12
        return np.linalg.solve(m[:-1, :-1] + penalty, m[:-1, -1])

    def missed(ridge):
        error = 0.0
        for m in sums.values():
            beta = np.append(solve(total - m, ridge), -1.0)
            error += beta @ m @ beta
        return error

    ridge = min(RIDGES, key=missed)
    left_out = np.stack([solve(total - sums[f], ridge) for f in range(FOLDS)])

    def binned(batches):
        n, one = np.zeros(BINS), np.zeros(BINS)
        for b in batches:
            raw = np.einsum("ij,ij->i", blank.features(_stack(b.column("x"))), left_out[b.column("fold").to_numpy()])
            at = np.clip((raw + 0.5) * (BINS / 2), 0, BINS - 1).astype(int)
            n += np.bincount(at, minlength=BINS)
            one += np.bincount(at, b.column("y").to_numpy(), minlength=BINS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bin": at.astype(np.int32), "n": n[at], "one": one[at]})

    seen = sorted(folded.mapInArrow(binned, "bin int, n double, one double").groupBy("bin")
                  .agg(F.sum("n").alias("n"), F.sum("one").alias("one")).collect())
    blank.knots, blank.chances = isotonic(np.array([(r.bin + 0.5) * 2 / BINS - 0.5 for r in seen]),
                                          np.array([r.n for r in seen]), np.array([r.one for r in seen]))
    blank.beta = solve(total, ridge)
    return blank


def _fold() -> Column:
    return (F.abs(F.xxhash64("doc_id", F.lit(17))) % FOLDS).cast("int")


def learn(docs: DataFrame, labels: DataFrame, held_out_mod: int = 3, held_out_rest: int = 1, **options) -> Scorer:
    """Fit on the labelled rows whose crc32(doc_id as text) modulo is another."""
    statistics_of = docs if docs.columns == ["doc_id", "x"] else text_statistics(id_and_text(docs))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
             .where("doc_id IS NOT NULL AND y IS NOT NULL").where(crc_mod_col(F.col("doc_id"), held_out_mod) != held_out_rest)
             .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    return fit(stage(statistics_of.join(known, "doc_id"), "quality-train"), **options)


def score_quality(docs: DataFrame, labels: DataFrame, held_out_mod: int = 3, held_out_rest: int = 1, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``."""
    prepare(docs.sparkSession)
    rows = stage(text_statistics(id_and_text(docs)), "quality-statistics")
    scorer = learn(rows, labels, held_out_mod, held_out_rest, **options)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            yield record(schema, doc_id=b.column("doc_id"), score=scorer.scores(_stack(b.column("x"))))

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_mod_col(F.col("doc_id"), held_out_mod) == held_out_rest).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they are; texts are not shuffled."""
    prepare(docs.sparkSession)
    scorer = learn(docs, labels, **options)
    at, schema = docs.columns.index("text"), docs.schema

    def run(batches):
        for b in batches:
            x = np.array([statistics(t) for t in text_bytes(b.column(at))]).reshape(b.num_rows, -1)
            yield b.filter(pa.array(scorer.scores(x) >= 0.5)) if b.num_rows else b

    return docs.mapInArrow(run, schema)
