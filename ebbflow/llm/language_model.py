"""Language-model scoring by a log-bilinear neural model (operator 4).

Tokens are the words of the lower-cased text and an end after each text.
One pass over all training texts gives every token's count and the counts of
pairs of neighbours among the ``head`` most frequent tokens (the others act as
one rare token there, and a start stands before each text).

The model predicts the next token from the one before it: with context
vectors R, target vectors Q and biases b, the score of w after h is
R[h].Q[w] + b[w]. It is trained in numpy by noise-contrastive estimation on
the pair counts of the whole corpus: minibatches drawn by count are told from
noise drawn from the unigram distribution. A few replicas each take a share of
the texts' pairs, and their parameters are averaged after every round. Training work
and memory are bounded by ``head``, whatever the corpus size.

Scores are normalised: batched matrix products R Q' + b give the log of the sum
over all targets for every context, so a token's probability is
softmax(R Q' + b)[h, w]. A rare token has the rare target's probability times
its smoothed share (c + 0.1) / (C + 0.1 (V + 1)) among the C rare training
tokens of V kinds, an unseen token being one more kind.

Counts of the ``known`` most frequent tokens (a bound of 16 bytes each) go to
every task; the counts of all other tokens are joined by a shuffle, so no
token is dropped. Words are compared by 64-bit hashes (``hashing``).

Results by case: a null or empty text is one token, the end. Repeated rows are
scored each, and each counts in training. A null id counts as the empty text
for holding out. Without training rows N and V are 0, every token is unseen,
and the model has the rare target alone. Extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import crc_mod, id_and_text, prepare, record, stage, text_bytes
from ebbflow.llm.hashing import hash_words, text_groups

END = np.uint64(0x5EED0E4D0F7E8D11)  # the end token's hash
FLUSH = 2_000_000  # distinct keys a task holds before it emits partial counts


@dataclass
class Model:
    words: np.ndarray  # hashes of the known tokens, ascending
    counts: np.ndarray  # their counts
    ids: np.ndarray  # their ids in the head; the rare id if beyond
    context: np.ndarray  # R, a row for each head token, the rare token and the start
    target: np.ndarray  # Q, a row for each head token and the rare token
    bias: np.ndarray
    log_sum: np.ndarray  # log of the sum over all targets, by context
    total: int  # N
    kinds: int  # V
    rare_total: int
    rare_kinds: int

    @property
    def rare(self) -> int:
        return len(self.bias) - 1


def token_streams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts with an end after each, and the end positions + 1."""
    words, counts = hash_words(texts)
    ends = np.cumsum(counts + 1)
    tokens = np.full(len(words) + len(texts), END)
    is_word = np.ones(len(tokens), bool)
    is_word[ends - 1] = False
    tokens[is_word] = words
    return tokens, ends


class _Counter:
    """Counts of int64 keys, emitted in parts of bounded size."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.parts.append((k, n))
        self.size += len(k)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n for _, n in self.parts])).astype(np.int64)
        self.parts, self.size = [(keys, n)], len(keys)
        return keys, n


_COUNTS = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def _count_job(source: DataFrame, held_out_mod: int, keys_of) -> DataFrame:
    """``(key, n)`` over all training rows; partial counts per task before the shuffle."""
    def run(batches):
        counter = _Counter()
        for b in batches:
            train = [crc_mod(i, held_out_mod) != 0 for i in b.column("doc_id").to_pylist()]
            texts = [t for t, use in zip(text_bytes(b.column("text")), train, strict=True) if use]
            for part in text_groups(texts):
                counter.add(keys_of(texts[part]))
                if counter.size > 2 * FLUSH and len(counter.merged()[0]) > FLUSH:
                    keys, n = counter.merged()
                    yield record(_COUNTS, key=keys, n=n)
                    counter = _Counter()
        keys, n = counter.merged()
        yield record(_COUNTS, key=keys, n=n)

    return source.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _head_ids(words: np.ndarray, ids: np.ndarray, rare: int, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens' places among the known words (-1: not there) and their head ids."""
    at = np.searchsorted(words, tokens)
    at[at == len(words)] = 0
    at = np.where(words[at] == tokens, at, -1) if len(words) else np.full(len(tokens), -1)
    return at, (np.where(at >= 0, ids[at], rare) if len(words) else np.full(len(tokens), rare))


def _contexts(targets: np.ndarray, ends: np.ndarray, start: int) -> np.ndarray:
    """The token before each; the start at each text's beginning."""
    before = np.concatenate([[start], targets[:-1]]) if len(targets) else targets
    before[ends[:-1]] = start
    return before


def train_replica(pairs: np.ndarray, n: np.ndarray, context, target, bias, noise: np.ndarray, steps: int,
                  batch: int, noise_words: int, rate: float, seed: int):
    """Noise-contrastive estimation on pair counts; pairs are context * targets + target."""
    rng = np.random.default_rng(seed)
    size = len(bias)
    context, target, bias = context.copy(), target.copy(), bias.copy()
    if not len(pairs):
        return context, target, bias
    sums = [np.full(len(context), 1e-3), np.full(size, 1e-3), np.full(size, 1e-3)]  # of squared gradients, by row
    share, noise_share = np.cumsum(n / n.sum()), np.cumsum(noise)
    log_noise = np.log(noise_words * noise).astype(np.float32)
    for _ in range(steps):
        drawn = pairs[np.minimum(np.searchsorted(share, rng.random(batch)), len(pairs) - 1)]
        h, w = drawn // size, drawn % size
        k = np.minimum(np.searchsorted(noise_share, rng.random(noise_words)), size - 1)
        r, q, qk = context[h], target[w], target[k]
        delta = np.einsum("ij,ij->i", r, q) + bias[w] - log_noise[w]
        delta_k = r @ qk.T + (bias[k] - log_noise[k])
        err = 1 / (1 + np.exp(np.clip(delta, -30, 30)))  # how far the pair is from being told true
        err_k = -1 / (1 + np.exp(np.clip(-delta_k, -30, 30)))  # and the noise from being told false
        for values, rows, gradient, squares in (
                (context, h, err[:, None] * q + err_k @ qk, sums[0]),
                (target, np.concatenate([w, k]), np.concatenate([err[:, None] * r, err_k.T @ r]), sums[1]),
                (bias, np.concatenate([w, k]), np.concatenate([err, err_k.sum(0)]), sums[2])):
            order = np.argsort(rows, kind="stable")
            at, first = np.unique(rows[order], return_index=True)
            g = np.add.reduceat(gradient[order], first) / batch
            squares[at] += (g * g).mean(1) if g.ndim == 2 else g * g
            step = rate / np.sqrt(squares[at])
            values[at] += (step[:, None] if g.ndim == 2 else step) * g
    return context, target, bias


def _level():
    """Counts on a scale of eight steps for each doubling."""
    return F.floor(F.log2("n") * 8)


def _least_level(counts: DataFrame, known: int) -> int:
    """The lowest level from which upwards there are at most ``known`` tokens."""
    least, held = 1 << 20, 0
    for level, n in sorted(counts.groupBy(_level().alias("level")).count().collect(), reverse=True):
        held += n
        if held > known:
            break
        least = level
    return least


def fit(source: DataFrame, held_out_mod: int = 10, head: int = 4096, known: int = 1 << 20, dims: int = 32,
        replicas: int = 4, rounds: int = 2, steps: int = 1500, batch: int = 2048, noise_words: int = 128,
        rate: float = 0.6, seed: int = 11) -> tuple[Model, DataFrame]:
    """The trained model and the counts ``(key, n)`` of the tokens that it does not hold."""
    counts = stage(_count_job(source, held_out_mod, lambda texts: token_streams(texts)[0].view(np.int64)), "lm-counts")
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = _least_level(counts, known)
    top = counts.where(_level() >= least).toArrow()  # at most ``known`` rows of 16 bytes
    words, n = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.lexsort((words, -n))  # by rank
    size = min(head, len(words))
    by_word = np.argsort(words)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    n_head = n[order[:size]]
    words, known_counts, ids = words[by_word], n[by_word], np.minimum(rank[by_word], size).astype(np.int32)
    rare_total, rare_kinds = int(total - n_head.sum()), int(kinds - size)

    def pair_keys(texts):
        tokens, ends = token_streams(texts)
        targets = _head_ids(words, ids, size, tokens)[1].astype(np.int64)
        # A text goes to one replica, so every replica sees a fair share of all pairs' counts.
        share = np.add.reduceat(tokens, np.append(0, ends[:-1])) % np.uint64(replicas)
        replica = np.repeat(share.astype(np.int64), np.diff(ends, prepend=0))
        return replica * cells + _contexts(targets, ends, size + 1) * (size + 1) + targets

    cells = (size + 2) * (size + 1)
    pairs = stage(_count_job(source, held_out_mod, pair_keys), "lm-pairs")
    noise = np.concatenate([n_head, [rare_total]]) + 0.1
    noise = noise / noise.sum()
    rng = np.random.default_rng(seed)
    context = rng.normal(0, 0.1, (size + 2, dims)).astype(np.float32)
    target = rng.normal(0, 0.1, (size + 1, dims)).astype(np.float32)
    bias = np.log(noise).astype(np.float32)
    for turn in range(rounds):
        def replica(key, rows: pd.DataFrame) -> pd.DataFrame:
            r, q, b = train_replica(rows["key"].to_numpy() % cells, rows["n"].to_numpy(), context, target, bias, noise, steps, batch,
                                    noise_words, rate / (turn + 1), seed + 97 * turn + int(key[0]))
            return pd.DataFrame({"weight": [float(rows["n"].sum())], "r": [r.tobytes()], "q": [q.tobytes()], "b": [b.tobytes()]})

        share = pairs.withColumn("replica", F.floor(F.col("key") / cells).cast("int"))
        made = share.groupBy("replica").applyInPandas(replica, "weight double, r binary, q binary, b binary").collect()
        weight = sum(m.weight for m in made)
        if weight:
            context, target, bias = (
                sum(np.frombuffer(m[name], np.float32).astype(float) * m.weight for m in made).reshape(like.shape).astype(np.float32) / np.float32(weight)
                for name, like in (("r", context), ("q", target), ("b", bias)))
    log_sum = np.concatenate([_log_sum(context[i:i + 512] @ target.T + bias) for i in range(0, len(context), 512)])
    return Model(words, known_counts, ids, context, target, bias, log_sum, int(total), int(kinds), rare_total, rare_kinds), counts.where(_level() < least)


def _log_sum(scores: np.ndarray) -> np.ndarray:
    most = scores.max(1, keepdims=True)
    return (most[:, 0] + np.log(np.exp((scores - most).astype(np.float64)).sum(1)))


def log_probabilities(m: Model, h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """log P(w | h) of head targets, in batches."""
    out = np.empty(len(h))
    for i in range(0, len(h), 1 << 15):
        s = slice(i, i + (1 << 15))
        out[s] = np.einsum("ij,ij->i", m.context[h[s]], m.target[w[s]]) + m.bias[w[s]] - m.log_sum[h[s]]
    return out


_PART = pa.schema([("doc_id", pa.int64()), ("locator", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                   ("base", pa.float64()), ("model", pa.float64()), ("tail_words", pa.list_(pa.int64()))])
_PART_DDL = "doc_id long, locator long, n_tokens long, n_known long, base double, model double, tail_words array<long>"


def score_texts(docs: DataFrame, held_out_mod: int = 10, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row."""
    spark = docs.sparkSession
    prepare(spark)
    source = id_and_text(docs, id_col, text_col)
    m, tail_counts = fit(source, held_out_mod, **fit_options)
    shared = spark.sparkContext.broadcast(m)
    all_counted = len(m.words) == m.kinds

    def run(batches):
        m = shared.value
        base_of = np.log10(m.counts + 0.1)
        rest = np.log10(m.rare_total + 0.1 * (m.rare_kinds + 1))
        base_rest = np.log10(m.total + 0.1 * (m.kinds + 1))
        locator = TaskContext.get().partitionId() << 33
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), text_bytes(b.column("text"))
            for part in text_groups(texts):
                tokens, ends = token_streams(texts[part])
                at, w = _head_ids(m.words, m.ids, m.rare, tokens)
                h = _contexts(w.astype(np.int64), ends, m.rare + 1)
                known, rare = at >= 0, w == m.rare
                count_log = np.where(known, base_of[at] if len(base_of) else 0.0, 0.0)  # log10 (c + 0.1), where c is at hand
                model = log_probabilities(m, h, w) / np.log(10) + np.where(rare, count_log - rest, 0.0)
                begins = np.concatenate([[0], ends[:-1]])
                sums = [np.add.reduceat(x, begins) for x in (known.astype(np.int64), count_log - base_rest, model)]
                yield record(_PART, doc_id=ids[part], locator=range(locator, locator + len(ends)), n_tokens=ends - begins,
                             n_known=sums[0], base=sums[1], model=sums[2],
                             tail_words=[tokens[i:j][~known[i:j]].view(np.int64) for i, j in zip(begins, ends, strict=True)])
                locator += len(ends)

    parts = source.mapInArrow(run, _PART_DDL)
    if all_counted:  # every training token was at hand: the others are unseen
        parts = parts.withColumn("log_sum", F.size("tail_words") * F.log10(F.lit(0.1))).withColumn("found", F.lit(0).cast("long"))
    else:
        parts = stage(parts, "lm-parts")
        tail = parts.select("locator", F.explode("tail_words").alias("key"))
        looked_up = (tail.join(tail_counts, "key", "left").groupBy("locator")
                     .agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("log_sum"), F.count("n").alias("found")))
        parts = parts.drop("tail_words").join(looked_up, "locator", "left").fillna(0.0, ["log_sum"]).fillna(0, ["found"])
    return parts.select(
        "doc_id", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % held_out_mod == 0).alias("held_out"),
        "n_tokens", (F.col("n_known") + F.col("found")).alias("n_known"), F.lit(m.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("log_sum")).alias("base_score"), (F.col("model") + F.col("log_sum")).alias("score"))
