"""Token counts, packing and sharding against the library and plain Python."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import docs, frame, odd_rows

from ebbflow.llm import packing, sharding, token_counts
from ebbflow.llm.word_tokens import TokenIds, load_tokenizer, prove_whole_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return prove_whole_tokens(PATH)


def library_ids(text):
    return load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library_on_odd_texts(whole):
    ids, rng = TokenIds(PATH, whole), random.Random(1)
    alphabet = "aB's t're!?<|>endoftext0²½ÀÉßÿªº×÷\t\n\r _-’—€…“„İΣς\x0b\xa0́e"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += [t + "<|endoftext|>" + t for t in texts[:200]]
    for t in texts:
        assert np.frombuffer(ids.id_bytes(t), "<u4").tolist() == library_ids(t), repr(t)
        assert ids.count(t) == len(library_ids(t))


def test_whole_tokens_encode_alone(whole):
    words = random.Random(2).sample(sorted(whole), 500)
    assert len(whole) > 20_000 and all(library_ids(w) == [whole[w]] for w in words)


def test_full_word_table_still_counts(whole, monkeypatch):
    monkeypatch.setattr("ebbflow.llm.word_tokens.MAX_CACHED_WORDS", 0)
    assert TokenIds(PATH, whole).count("zzqqx, zzqqx") == len(library_ids("zzqqx, zzqqx"))


def test_counts(spark):
    got = token_counts.count_tokens(frame(spark), PATH, limit=100).collect()
    exp = [(i, len((t or "").encode()), len(library_ids(t)), len(library_ids(t)) > 100) for i, t, *_ in odd_rows()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, exp))
    assert token_counts.count_tokens(frame(spark, []), PATH).count() == 0


def test_the_driver_loads_no_tokenizer(spark, monkeypatch):
    def load(path):
        raise AssertionError("loaded in the driver")

    monkeypatch.setattr("ebbflow.llm.word_tokens.load_tokenizer", load)
    rows = docs(spark, [(1, "Some words, some more"), (2, None)])
    assert token_counts.count_tokens(rows, PATH).count() == 2
    assert {r.doc_id for r in packing.pack_documents(rows, PATH).select("doc_id").collect()} == {1, 2}


@pytest.mark.parametrize("max_tokens,buffer", [(2048, 2_000_000), (256, 1000), (8, 50)])
def test_packing_holds_every_id_once(spark, max_tokens, buffer):
    rows = packing.pack_documents(frame(spark), PATH, max_tokens=max_tokens, buffer_tokens=buffer).collect()
    docs = defaultdict(list)
    for r in rows:
        docs[r.doc_id, r.doc_tokens].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        assert len(r.ids) == 4 * r.length > 0
    got = Counter()
    for (i, n), pieces in docs.items():  # repeated rows of an id give the same pieces or others, but all of each
        ids = Counter()
        for start, part in pieces:
            ids.update((start + k, x) for k, x in enumerate(part))
        got[i, n] = ids
    exp = defaultdict(Counter)
    for i, t, *_ in odd_rows():
        ids = library_ids(t) + [1]
        exp[i, len(ids)].update(enumerate(ids))
    assert got == Counter(exp)
    for pieces in _sequences(rows).values():
        size = sum(r.length for r in pieces)
        assert [r.offset for r in pieces] == [sum(x.length for x in pieces[:k]) for k in range(len(pieces))]
        assert size <= max_tokens and size & (size - 1) == 0 and {r.tier for r in pieces} == {size}
    steps = defaultdict(int)
    for pieces in _sequences(rows).values():
        steps[pieces[0].step_id] += sum(r.length for r in pieces)
    assert max(steps.values()) <= 32768


def _sequences(rows):
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.offset):
        found[r.sequence_id].append(r)
    return found


def test_packing_fills_long_gaps_from_short_tiers():
    p = packing.Packer(2048)
    for i, n in enumerate([1500, 300, 200, 48, 1100, 900, 48]):
        p.add(packing.Piece(i, 0, bytes(4 * n), n))
    windows = p.pack()
    assert [sorted(len(x) for x in w) for w in windows] == [[48, 200, 300, 1500], [48, 900, 1100]]
    assert p.pack(last=True) == []


def test_packing_tiers_do_not_depend_on_the_buffer(spark):
    rng = random.Random(9)
    sizes = [min(int(rng.lognormvariate(5.5, 1)) + 1, 6000) for _ in range(4000)]
    source = docs(spark, [(i, "a " * n) for i, n in enumerate(sizes)]).coalesce(1)
    shares = []
    for buffer in (60_000, 10**9):
        rows = packing.pack_documents(source, PATH, buffer_tokens=buffer).collect()
        tokens = Counter()
        for r in rows:
            tokens[r.tier] += r.length
        shares.append({t: tokens[t] / sum(tokens.values()) for t in (256, 512, 1024, 2048)})
        assert sum(tokens.values()) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    assert all(abs(shares[0][t] - shares[1][t]) < 0.03 for t in shares[0]), shares
    assert min(shares[1].values()) > 0.05


def test_step_groups_are_balanced():
    rng = random.Random(3)
    windows = [(1024, rng.randint(1, 1000)) for _ in range(64)] + [(256, 5)] * 3
    steps, after = packing.step_groups(windows, 8192, 10)
    cost, size = Counter(), Counter()
    for s, (n, c) in zip(steps, windows, strict=True):
        cost[s] += c
        size[s] += n
    assert set(steps) == set(range(10, after)) and max(size.values()) <= 8192
    full = [cost[s] for s in cost if size[s] == 8192]
    assert len(full) == 8 and max(full) < 1.3 * min(full)


def test_packing_bad_size_and_empty(spark):
    assert packing.pack_documents(frame(spark, []), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(frame(spark), PATH, max_tokens=1000)


def plain_table(shards, size):
    """Turns taken literally: a set of free slots and each shard's whole preference list."""
    order = []
    for s in shards:
        offset, skip = sharding._number(f"{s}#offset") % size, sharding._number(f"{s}#skip") % (size - 1) + 1
        order.append(iter([(offset + j * skip) % size for j in range(size)]))
    owner = {}
    while len(owner) < size:
        for i, prefer in enumerate(order):
            if len(owner) < size:
                owner[next(slot for slot in prefer if slot not in owner)] = i
    return [owner[k] for k in range(size)]


def test_table_is_the_plain_one_and_moves_little():
    names = [f"s{i}" for i in range(7)]
    assert sharding.fill_table(names, 251) == plain_table(names, 251)
    before, after = sharding.fill_table(names, 65537), sharding.fill_table(names[:-1], 65537)
    held = Counter(before)
    assert max(held.values()) - min(held.values()) <= 1
    assert sum(a != b for a, b in zip(before, after, strict=True) if a != 6) < 0.15 * 65537
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 100)


def test_shards_of_rows(spark, tmp_dir):
    df = frame(spark).withColumnRenamed("digest", "shard").withColumnRenamed("kept", "slot")
    out = sharding.assign_shards(df, "doc_id", ["a", "b", "c"], 101)
    assert out.columns == [c for c in df.columns if c not in ("slot", "shard")] + ["slot", "shard"]
    owner = sharding.fill_table(["a", "b", "c"], 101)
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        slot = sharding._number("" if r.doc_id is None else str(r.doc_id)) % 101
        assert (r.slot, r.shard) == (slot, "abc"[owner[slot]])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert sharding.assign_shards(frame(spark, []), "doc_id", ["a"]).count() == 0
    sharding.write_shards(frame(spark).select("doc_id", "text"), f"{tmp_dir}/s", "doc_id", ["a", "b", "c"], 101)
    assert spark.read.parquet(f"{tmp_dir}/s").count() == len(odd_rows())


def test_crc_is_the_plain_one():
    from ebbflow.llm.common import crc_mod
    assert crc_mod(123, 10) == zlib.crc32(b"123") % 10 and crc_mod(None, 3) == 0
