"""Classifier, language model, mixing, nearest neighbours and the pipeline."""
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import docs, frame, odd_rows
from pyspark.sql import functions as F

import corpus_pipeline
from ebbflow.llm import language_model, mixing, multi_index, quality, queries, word_tokens
from ebbflow.llm.common import table
from ebbflow.llm.shared_filter import shared_filter
from ebbflow.llm.text_features import NAMES, statistics

SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# ------------------------------------------------------------------ quality
def test_quality_on_held_out_rows(spark):
    scored = quality.score_quality(table(spark, SF, "documents"), table(spark, SF, "labels"))
    rows = scored.join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    for r in rows:
        assert (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean([[a > b for a in good] for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_quality_odd(spark):
    made = [(100 + i, "plain words of a text " * (1 + i % 3)) for i in range(40)] + [(200 + i, "BAD!! %% TEXT!! " * (1 + i % 4)) for i in range(40)]
    known = labels(spark, [(i, int(i < 200), None) for i, _ in made] + [(1, None, 0), (None, 1, 0), (100, 1, 1)])
    both = frame(spark).select("doc_id", "text").unionByName(docs(spark, made))
    rows = quality.score_quality(both, known).collect()
    assert len(rows) == len(odd_rows()) + 80 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.doc_id < 200) for r in rows if r.doc_id and r.doc_id >= 100)
    kept = quality.keep_good(both.select("text", F.lit(None).cast("int").alias("x"), "doc_id"), known)
    assert kept.columns == ["text", "x", "doc_id"] and {r.doc_id for r in kept.collect() if r.doc_id and r.doc_id >= 100} == set(range(100, 140))
    assert quality.score_quality(frame(spark, []), known).count() == 0
    for rows, score in (([], 0.5), ([(i, 1, 0) for i in range(1, 16)], 1.0)):  # no label, one class
        assert {r.score for r in quality.score_quality(frame(spark), labels(spark, rows)).collect()} == {score}


def test_statistics_are_finite_for_any_text():
    rng = random.Random(4)
    for n in (0, 1, 2, 500):
        x = statistics(bytes(rng.randrange(256) for _ in range(n)))
        assert len(x) == len(NAMES) and np.isfinite(x).all()


def test_isotonic_is_the_least_squares_order():
    rng = np.random.default_rng(2)
    bins, n = np.arange(30.0), rng.integers(1, 9, 30)
    ones = np.minimum(n, rng.integers(0, 9, 30))
    knots, chances = quality.isotonic(bins, n, ones)
    assert (np.diff(knots) > 0).all() and (np.diff(chances) > 0).all()
    means = ones / n  # min-max formula
    exp = [max(min(ones[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, 30)) for a in range(i + 1)) for i in range(30)]
    assert set(np.round(chances, 9)) == set(np.round(exp, 9)) and len(means) == 30


# ------------------------------------------------------------------ language model
def plain_base(pairs, mod=10):
    tokens = [(t or "").encode().lower().split() + [None] for _, t in pairs]
    train = [zlib.crc32(b"" if i is None else str(i).encode()) % mod != 0 for i, _ in pairs]
    c = Counter(x for t, use in zip(tokens, train, strict=True) if use for x in t)
    total, kinds = sum(c.values()), len(c)
    base = [sum(np.log10((c[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in t) for t in tokens]
    return [(i, not use, len(t), sum(c[x] > 0 for x in t), total, round(float(b), 6)) for (i, _), use, t, b in zip(pairs, train, tokens, base, strict=True)]


FAST = {"steps": 20, "batch": 256, "noise_words": 16, "dims": 8, "rounds": 1, "replicas": 2}


@pytest.mark.parametrize("sizes", [{"head": 4096, "known": 1 << 20}, {"head": 5, "known": 12}])
def test_language_model_base_is_the_plain_one(spark, sizes):
    pairs = [(i, t) for i, t, *_ in odd_rows()] + [(20 + i, f"some text {i % 7} words") for i in range(40)]
    extra = frame(spark).select("doc_id", "text").unionByName(docs(spark, pairs[len(odd_rows()):]))
    rows = language_model.score_texts(extra, **sizes, **FAST).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, plain_base(pairs)))
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)


def test_language_model_probabilities_add_up(spark):
    source = docs(spark, [(i, f"a b {'c' if i % 3 else 'd'} e") for i in range(200)])
    m, _ = language_model.fit(source, head=4, **FAST)
    for h in range(len(m.context)):
        p = np.exp(language_model.log_probabilities(m, np.full(len(m.bias), h), np.arange(len(m.bias))))
        assert abs(p.sum() - 1) < 1e-5
    rare = 0.1 * (m.rare_kinds + 1) + m.rare_total  # the rare tokens' shares, an unseen one among them
    counts = m.counts[m.ids == m.rare]
    assert abs((counts + 0.1).sum() + 0.1 - rare) < 1e-9


def test_language_model_beats_the_base(spark):
    rows = language_model.score_texts(table(spark, SF, "documents")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_without_training_rows(spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = language_model.score_texts(docs(spark, [(held, "a b")]), **FAST).first()
    assert row.held_out and (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert abs(row.base_score) < 1e-9 and np.isfinite(row.score)
    assert language_model.score_texts(frame(spark, []), **FAST).count() == 0


# ------------------------------------------------------------------ mixing
def test_rates_meet_targets(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 100, 400)
    soft = spark.createDataFrame([(i, int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p, strict=True))],
                                 "doc_id long, __n_tokens long, __posterior array<double>")
    goal = {"a": 0.5, "b": 0.3, "c": 0.2, "unknown": 7}
    for bounds in ({}, {"min_rate": 0.5, "max_rate": 1.6}):
        steps = mixing.fit_rates(soft, ["a", "b", "c"], goal, tolerance=1e-6, **bounds)
        rates = np.array([r[0] for r in soft.orderBy("doc_id").select(mixing.rate_column(steps, 3, **bounds)).collect()])
        weight = np.array([0.5, 0.3, 0.2]) * n.sum()
        assert (rates >= bounds.get("min_rate", 0)).all() and (rates <= bounds.get("max_rate", np.inf)).all()
        r = np.ones(400)  # the same steps in plain numpy, from a rate of one
        gram = (p * n[:, None]).T @ p
        for _ in steps:
            r = np.clip(r - p @ (np.linalg.pinv(gram, rcond=1e-9, hermitian=True) @ ((p * n[:, None]).T @ r - weight)),
                        bounds.get("min_rate", 0), bounds.get("max_rate", np.inf))
        assert np.abs(rates - r).max() < 1e-6
        assert np.abs((p * n[:, None]).T @ rates - weight).max() < 2e-3 * n.sum()
    assert mixing.fit_rates(soft, ["a", "b", "c"], {"x": 1}) == []


def test_mixing_domains_and_copies(spark):
    d, known = table(spark, SF, "documents"), table(spark, SF, "labels")
    rates, names, _ = mixing.domain_rates(d, known, queries.LABEL_DOMAIN, queries.TARGETS)
    rows = rates.collect()
    total = sum(r.n_tokens for r in rows)
    for k, name in enumerate(names):
        share = sum(r.rate * r.n_tokens * r.posterior[k] for r in rows) / total
        drawn = sum(r.copies * r.n_tokens * r.posterior[k] for r in rows) / total
        assert abs(share - queries.TARGETS.get(name, 0.0)) < 2e-3 and abs(drawn - share) < 0.05
    assert all(r.copies >= 1 for r in rows if r.rate >= 1) and all(abs(r.copies - r.rate) < 1 for r in rows)
    texts = {r.doc_id: r.text for r in d.collect()}
    assert all(r.n_tokens == len(texts[r.doc_id].encode().split()) for r in rows)


def test_mixing_odd(spark):
    known = labels(spark, [(1, 1, 0), (None, 1, 0), (5, None, 0), (7, 0, 1), (7, 1, 1)])
    for rows in (known, labels(spark, [])):
        rates, names, _ = mixing.domain_rates(frame(spark), rows, queries.LABEL_DOMAIN, queries.TARGETS)
        got = rates.collect()
        assert len(got) == len(odd_rows()) and all(abs(sum(r.posterior) - 1) < 1e-9 and r.rate >= 0 for r in got)
    assert names == ["all"] and {r.rate for r in got} == {1.0}
    mixed = mixing.mix(frame(spark), known, queries.LABEL_DOMAIN, {"quality1_toxic0": 1.0}, repeat=False, max_rate=1.0)
    assert mixed.columns == frame(spark).columns and mixed.count() <= len(odd_rows())
    assert mixing.mix(frame(spark, []), known, queries.LABEL_DOMAIN, queries.TARGETS).count() == 0


def test_domains_are_fitted_without_writing_texts(spark, monkeypatch):
    kinds = [(i, "red apple pie" if i % 3 else "blue stone wall", i % 3 > 0) for i in range(120)]
    d = docs(spark, [(i, t) for i, t, _ in kinds])
    staged, write = [], mixing.stage
    monkeypatch.setattr(mixing, "stage", lambda df, name: staged.append((name, df.columns)) or write(df, name))
    found = mixing.fit_domains(d, labels(spark, [(i, int(q), 0) for i, _, q in kinds]), queries.LABEL_DOMAIN)
    assert [n for n, columns in staged if "text" in columns] == []
    assert found.names == ["quality0_toxic0", "quality1_toxic0"] and set(found.tokens) == {b"red", b"apple", b"pie", b"blue", b"stone", b"wall"}
    p = found.posteriors([[found.tokens[b"red"]], [found.tokens[b"blue"]]])
    assert p[0, 1] > 0.99 and p[1, 0] > 0.99


@pytest.mark.parametrize("clean", [0.99, 0.6])
def test_the_pipelines_mixing_keeps_every_clean_document(spark, tmp_path, clean):
    kinds = {i: "clean" if i < 2000 * clean else ("toxic", "poor")[i % 2] for i in range(2000)}
    words = {"clean": "plain", "toxic": "vile", "poor": "junk"}
    d = docs(spark, [(i, f"{words[k]} text number n{i % 9}") for i, k in kinds.items()])
    labels(spark, [(i, int(k != "poor"), int(k == "toxic")) for i, k in kinds.items()]).write.parquet(f"{tmp_path}/labels.parquet")
    kept = Counter(kinds[r.doc_id] for r in corpus_pipeline.mix_domains(spark, d, str(tmp_path)).collect())
    have = Counter(kinds.values())
    assert kept["clean"] == have["clean"]
    for k, target in (("toxic", 0.03), ("poor", 0.02)):
        goal = min(have[k], have["clean"] * target / 0.95)
        assert abs(kept[k] - goal) <= (0 if goal == have[k] else 4 * goal ** 0.5)


def test_rates_with_a_whole_domain(spark):
    rng = np.random.default_rng(8)
    n, p = rng.integers(1, 100, 600), rng.dirichlet([0.3, 0.1, 0.1], 600)
    soft = spark.createDataFrame([(i, int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p, strict=True))],
                                 "doc_id long, __n_tokens long, __posterior array<double>")
    steps = mixing.fit_rates(soft, ["a", "b", "c"], {"a": 0.6, "b": 0.25, "c": 0.15}, tolerance=1e-6, whole="a", max_rate=1.0)
    rates = np.array([r[0] for r in soft.orderBy("doc_id").select(mixing.rate_column(steps, 3, max_rate=1.0, whole=0)).collect()])
    mine = p[:, 0] >= p.max(1)
    assert (rates[mine] == 1).all() and (rates <= 1).all() and (rates >= 0).all()
    have = (p * n[:, None]).sum(0)
    goal = np.minimum(have, have[0] * np.array([0.6, 0.25, 0.15]) / 0.6)
    assert np.abs((p * n[:, None]).T @ rates - goal)[1:].max() < 2e-3 * n.sum()
    with pytest.raises(ValueError):
        mixing.fit_rates(soft, ["a", "b", "c"], {"b": 1.0}, whole="a")


# ------------------------------------------------------------------ nearest neighbours
def plain_nearest(vectors, asked, k):
    x = {i: np.array(v, float) for i, v in vectors}
    x = {i: v / np.linalg.norm(v) for i, v in x.items()}
    return {q: sorted(((-float((x[q] * v).sum()), i) for i, v in x.items() if i != q))[:k] for q in x if asked(q)}


def test_nearest_finds_nearly_all(spark):
    v = table(spark, SF, "embeddings")
    rows = multi_index.nearest(v, F.col("id") % 5 == 0, k=5, block_rows=64, query_rows=32).collect()
    exp = plain_nearest([(r.vec_id, r.embedding) for r in v.collect()], lambda i: i % 5 == 0, 5)
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert set(got) == set(exp) and all(len(x) == 5 for x in got.values())
    hits = sum(len({i for _, i in exp[q]} & {i for i, _ in got[q]}) for q in exp)
    assert hits >= 0.9 * 5 * len(exp)
    for q, found in got.items():
        assert [i for i, _ in found] == [i for _, i in sorted((-s, i) for i, s in found)]
    x = {r.vec_id: np.array(r.embedding, float) for r in v.collect()}
    for q, found in got.items():
        for i, s in found:
            assert abs(s - x[q] @ x[i] / np.linalg.norm(x[q]) / np.linalg.norm(x[i])) < 1e-12


def test_nearest_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (6, [1.0]), (None, [1.0, 1.0]),
            (50, [0.0, 1.0]), (8, [2.0, 0.0]), (7, [4.0, 0.0]), (9, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in multi_index.nearest(df, F.col("id") % 50 == 0).collect()]
    assert sorted(got) == [(0, 1, 7, 1.0), (0, 2, 8, 1.0), (0, 3, 50, 0.0), (0, 4, 9, -1.0),
                           (50, 1, 0, 0.0), (50, 2, 7, 0.0), (50, 3, 8, 0.0), (50, 4, 9, 0.0)]
    assert multi_index.nearest(df.where("vec_id = 2"), F.col("id") % 50 == 0).count() == 0
    assert multi_index.nearest(df.where("vec_id = 0"), F.col("id") % 50 == 0).count() == 0


def test_close_codes_are_found_without_probing_most_rows():
    rng = np.random.default_rng(12)
    centres = rng.integers(0, 256, (40, 32), np.uint8)
    code = centres[rng.integers(0, 40, 4000)] ^ np.packbits(rng.random((4000, 256)) < 0.02, axis=1)
    index = multi_index.BlockIndex(code)
    q, row, probed = index.within(code[:50], 24)
    apart = np.bitwise_count(code[:50, None] ^ code[None]).sum(2)
    assert sorted(zip(q.tolist(), row.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(apart <= 24))))
    assert probed.mean() < 0.25 * len(code)  # the buckets hold a part of the rows, and no others are looked at


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf):
    v = table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = multi_index.nearest(v, F.col("id") % 50 == 0, k=5).collect()
    x = np.array([r.embedding for r in v.orderBy("vec_id").collect()], float)
    ids = np.array([r.vec_id for r in v.select("vec_id").orderBy("vec_id").collect()])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    at = np.flatnonzero(ids % 50 == 0)
    near = x[at] @ x.T
    near[np.arange(len(at)), at] = -2
    exp = {(int(ids[a]), int(ids[b])) for a, best in zip(at, np.argsort(-near, axis=1, kind="stable")[:, :5]) for b in best}
    assert len(exp & {(r.query_id, r.vec_id) for r in rows}) >= 0.9 * len(exp)
    assert all(5 <= r.probed <= len(ids) for r in rows)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(4)
    code, query = rng.integers(0, 256, (500, 6), np.uint8), rng.integers(0, 256, (40, 6), np.uint8)
    code[:40] = query
    code[:40, 0] ^= 0b101
    apart = np.bitwise_count(query[:, None, :] ^ code[None]).sum(2)
    for radius in (0, 1, 2, 7, 13, 48):
        q, row, probed = multi_index.BlockIndex(code).within(query, radius)
        assert (probed >= np.bincount(q, minlength=len(query))).all()
        assert set(zip(q.tolist(), row.tolist(), strict=True)) == set(zip(*map(list, np.nonzero(apart <= radius)), strict=True))


# ------------------------------------------------------------------ shared hashes
def test_shared_filter(spark):
    rng = np.random.default_rng(5)
    once = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    rows = [once[i * 30:(i + 1) * 30].tolist() + [12345 << 40, int(once[7])] for i in range(100)]
    df = spark.createDataFrame([([int(np.uint64(x).astype(np.int64)) for x in set(r)],) for r in rows], "h array<long>").repartition(7)

    def hashes(batch):
        for h in batch.column(0):
            yield np.unique(h.values.to_numpy().view(np.uint64))

    f = shared_filter(df, hashes, 24)
    assert f.hits(np.array([12345 << 40, once[7]], np.uint64)).all()
    assert f.hits(once).mean() < 0.02 and pa.__version__


# ------------------------------------------------------------------ pipeline
def test_pipeline(spark):
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["quality", "exact_dedup", "jaccard_join", "mixing", "packing"]
    before = table(spark, SF, "documents").collect()
    known = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    d, sizes = table(spark, SF, "documents"), [len(before)]
    for name, step in corpus_pipeline.STAGES[:-1]:
        columns = d.columns
        d = queries_stage(step(spark, d, SF))
        assert d.columns == columns
        rows = d.collect()
        sizes.append(len(rows))
        texts = [(r.text or "").lower() for r in rows]
        if name == "exact_dedup":
            assert len(texts) == len(set(texts))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]
    kept = {r.doc_id for r in rows}
    bad = [i for i, r in known.items() if r.quality == 0]
    assert sum(i in kept for i in bad) < 0.05 * len(bad)
    pieces = by_name["packing"](spark, d, SF).collect()
    assert {p.doc_id for p in pieces} == kept


def test_pipeline_is_the_plain_one(spark, tmp_path):
    rng = random.Random(13)
    made = {}  # id: text, quality, toxic
    for i in range(400):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}" for _ in range(rng.randint(30, 90))]
        kind = "poor" if i % 10 == 0 else "toxic" if i % 10 < 3 else "clean"
        if kind == "poor":
            words = [w.upper() + "!!%" for w in words]
        elif kind == "toxic":
            words = [x for w in words for x in (w, rng.choice(["vile", "nasty"]))]
        made[i] = (" ".join(words), int(kind != "poor"), int(kind == "toxic"))
    for k, i in enumerate(rng.sample(sorted(made), 60)):
        text, *kinds = made[i]
        made[1000 + k] = (text.upper() if k % 3 == 0 and kinds[0] == 0 else text + " end" if k % 2 else text, *kinds)
    docs(spark, [(i, t) for i, (t, _, _) in made.items()]).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, [(i, q, x) for i, (_, q, x) in made.items()]).write.parquet(f"{tmp_path}/labels.parquet")
    known = table(spark, str(tmp_path), "labels")

    scored = quality.score_quality(table(spark, str(tmp_path), "documents"), known).collect()
    good = {r.doc_id: made[r.doc_id][0] for r in scored if r.predicted}
    by_text = {}
    for i in sorted(good):
        by_text[good[i].lower()] = i  # the largest id stays
    single = {i: good[i] for i in by_text.values()}
    sets = {i: {tuple(w[k:k + 5]) for w in [t.lower().split()] for k in range(len(w) - 4)} for i, t in single.items()}
    root = {i: i for i in single}
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = {k: a if r == b else r for k, r in root.items()}
    apart = {i: t for i, t in single.items() if root[i] == i}
    rates, _, _ = mixing.domain_rates(docs(spark, apart.items()), known, queries.LABEL_DOMAIN, queries.TARGETS, max_rate=1.0, whole=corpus_pipeline.WANTED)
    drawn = {r.doc_id for r in rates.collect() if r.copies}
    assert len(made) > len(good) > len(single) > len(apart) > len(drawn)

    library, pieces = word_tokens.load_tokenizer(queries.WORD_BPE), {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == drawn
    for i, found in pieces.items():
        ids, at = np.array([*library.encode(made[i][0], add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(found, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    clean = {i for i in apart if made[i][1:] == (1, 0)}
    assert clean and clean <= drawn


def queries_stage(df):
    from ebbflow.llm.common import stage
    return stage(df, "test-pipeline")


def test_pipeline_odd(spark):
    rows = frame(spark)
    for name, step in corpus_pipeline.STAGES:
        rows, none = queries_stage(step(spark, rows, SF)), step(spark, frame(spark, []), SF)
        assert none.count() == 0, name
    assert rows.count() > 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.QUERIES)
