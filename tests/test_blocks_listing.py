"""Record boundaries in blocks, records against Spark's own reader, and the file listing."""
import csv
import datetime as dt
import gzip
import hashlib
import io
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbflow.sources import blocks
from ebbflow.sources import files as S
from ebbflow.sources import listing as L
from ebbflow.sources.manifest import build_manifest


def plain_states(data: bytes):
    """The state before each byte, by a machine that reads byte by byte: 0 field start, 1 unquoted, 2 quoted, 3 quote in quoted."""
    state, out = 0, []
    for c in data:
        out.append(state)
        ch = chr(c)
        if state == 2:
            state = 3 if ch == '"' else 2
        elif state == 3 and ch == '"':
            state = 2
        elif ch in ",\n\r":
            state = 0
        elif ch == '"' and state == 0:
            state = 2
        else:
            state = 1
    return out


@given(st.lists(st.sampled_from(['a', '"', ',', '\n', '""', '"x"', ',"', '",', '\r\n', '"\n"']), max_size=40).map("".join), st.integers(1, 17))
@settings(max_examples=500, deadline=None)
def test_block_effects_compose(text, size):
    data = text.encode()
    states = plain_states(data)
    starts = {i + 1 for i, (c, s) in enumerate(zip(data, states)) if c == 10 and s != 2}
    inside, found = 0, {0}
    f = io.BytesIO(data)
    for offset in range(0, len(data), size):
        reset, toggles, outside_first, inside_first = blocks.block_effect(f, offset, min(size, len(data) - offset), 10)
        first = inside_first if inside else outside_first
        own = [s for s in sorted(starts) if offset < s <= offset + size]
        assert first == (own[0] if own else None)
        found |= {first} - {None}
        inside = toggles if reset else (inside + toggles) % 2
    assert found <= starts | {0}


@given(st.lists(st.sampled_from(['a', '"', ',', '\n', '""', ',"', '",']), max_size=40).map("".join), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_records_of_any_pieces(text, size):
    data = text.encode()
    states = plain_states(data)
    cuts = [i for i, (c, s) in enumerate(zip(data, states)) if c == 10 and s != 2]
    expected = [data[a:b].decode() for a, b in zip([0, *[c + 1 for c in cuts]], [*cuts, len(data)])]
    if expected[-1] == "":
        expected = expected[:-1]
    got = [r for part in blocks.records((data[i:i + size] for i in range(0, len(data), size)), "\n") for r in part]
    assert got == expected


def odd_csv(rng, rows, sep):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=sep)
    w.writerow(["adid", "created_at", "{Country}", "note"])
    for i in range(rows):
        note = rng.choice(["plain", 'a "quoted" word', "two\nlines", "a,b", '"', "", 'ends in comma,', '\n"\n', ",\n", "ü€"])
        w.writerow([f"u{i}", i, rng.choice(["US", ""]), note][: rng.choice([4, 4, 4, 3])] + (["more"] if rng.random() < 0.1 else []))
    return out.getvalue() + f'x,1,5" disc,y{sep}"u","7","a"b,"z"{sep}' + rng.choice(["", f'last,1,DE,"no\nend"'])


@pytest.mark.parametrize("sep", ["\n", "\r\n", "\r"])
def test_split_file_gives_the_rows_of_spark_reader(spark, tmp_dir, sep):
    rng = random.Random(hash(sep) % 100)
    data = odd_csv(rng, 300, sep)
    if sep == "\r":
        data = data.replace("\n", " ")
    with open(f"{tmp_dir}/ta_2024-01-01T00.csv.gz", "wb") as f:
        f.write(b"\xef\xbb\xbf" * (sep == "\r\n") + data.encode())
    whole = S.load_events(spark, tmp_dir)
    split = S.load_events(spark, tmp_dir, split_bytes=256)
    assert split.rows.rdd.getNumPartitions() > 1

    def rows(df):
        return sorted(map(str, df.select(*sorted(df.columns)).collect()))

    assert rows(split.rows) == rows(whole.rows) and split.rows.count() > 100
    assert split.bad_rows.count() == whole.bad_rows.count() > 10
    counts = [build_manifest(spark, x, include_content=False).first()["record_count"] for x in (whole, split)]
    assert counts[0] == counts[1] == split.rows.count() + split.bad_rows.count()


def test_many_headers_make_a_bounded_plan(spark, tmp_dir, monkeypatch):
    rng = random.Random(3)
    for k in range(30):
        names = ["adid", "created_at", *rng.sample([f"c{i}" for i in range(6)] + ["Country", "{country}", "date"], rng.randint(0, 3))]
        rng.shuffle(names)
        body = ",".join(names) + "\n" + "".join(",".join(f'"{n}\n{i}"' if rng.random() < 0.3 else f"{k}{i}" for n in names) + "\n" for i in range(5)) + "short\n"
        with (gzip.open if k % 3 else open)(f"{tmp_dir}/t{k}_2024-01-01T00.csv.gz", "wb") as f:
            f.write(body.encode())
    each = S.load_events(spark, tmp_dir)
    monkeypatch.setattr(S, "MOST_HEADERS", 2)
    by_name = S.load_events(spark, tmp_dir)

    def rows(df):
        return sorted(map(str, df.select(*sorted(df.columns)).collect()))

    assert rows(by_name.rows) == rows(each.rows) and by_name.rows.count() == 150
    assert by_name.bad_rows.count() == each.bad_rows.count() == 30
    # One read of records for each width of a header (three or four here), however many headers there are.
    assert by_name.rows._jdf.queryExecution().optimizedPlan().toString().count("from_csv") <= 2 * 4


def test_one_plain_file_is_read_by_many_tasks(spark, tmp_dir):
    with open(f"{tmp_dir}/ta_2024-01-01T00.csv.gz", "w") as f:
        f.write("adid,note\n" + "".join(f'u{i},"line\nbreak {i}"\n' for i in range(20_000)))
    files = S.classify_files(S.probe_files(S.list_source_files(spark, tmp_dir))).withColumnRenamed("is_gzip", "gzipped")
    ranges = blocks.record_ranges(files, 20_000).collect()
    assert len(ranges) > 20 and sorted(r["begin"] for r in ranges)[1:] == sorted(r["end"] for r in ranges)[:-1]
    rows = S.load_events(spark, tmp_dir, split_bytes=20_000).rows
    assert rows.count() == 20_000 and rows.where("note like 'line\nbreak %'").count() == 20_000


def test_small_blocks_share_tasks(spark):
    files = spark.createDataFrame([(40 << 20,), (3,), (0,)], "length long")
    assert blocks.n_tasks(files, 4096) <= 64
    assert blocks.n_tasks(files, 1 << 30) == 3
    assert blocks.n_tasks(files.where("length < 0"), 4096) == 1


def test_hidden_and_padded_files_are_read(spark, tmp_dir):
    body = b"adid,created_at\nu1,1\nu2,2\n"
    os.makedirs(f"{tmp_dir}/.deep/_er")
    for name, data in {"_a": body, ".b": gzip.compress(body), "c": gzip.compress(body) + bytes(700), ".deep/_er/d": body,
                       "e": gzip.compress(body) + b"junk", "f": gzip.compress(body) + bytes(9) + gzip.compress(b"u3,3\n"),
                       "_empty": b"", "_no_header": b"\n\n"}.items():
        with open(f"{tmp_dir}/{name}_2024-01-01T00.csv.gz", "wb") as f:
            f.write(data)
    scan = S.load_events(spark, tmp_dir, hash_bytes=True)
    status = {r["file_name"].split("_2024")[0]: r["status"] for r in scan.files.collect()}
    assert status == {"_a": "OK", ".b": "OK", "c": "OK", "d": "OK", "e": "CORRUPT_GZIP", "f": "OK", "_empty": "EMPTY_FILE", "_no_header": "NO_HEADER"}
    counts = {r["filename"].rsplit("/", 1)[1].split("_2024")[0]: r["count"] for r in scan.rows.groupBy("filename").count().collect()}
    assert counts == {"_a": 2, ".b": 2, "c": 2, "d": 2, "f": 3}
    with open(f"{tmp_dir}/c_2024-01-01T00.csv.gz", "rb") as f:
        assert {r["file_name"]: r["file_hash"] for r in scan.files.collect()}["c_2024-01-01T00.csv.gz"] == hashlib.sha256(f.read()).hexdigest()


def test_manifest_of_hidden_and_padded_files(spark, tmp_dir):
    body = b"adid,created_at\nu1,1\nu2,2\n"
    for name, data in {"_a": body, ".b": gzip.compress(body), "c": gzip.compress(body) + bytes(7), "d": body}.items():
        with open(f"{tmp_dir}/{name}_2024-01-01T00.csv.gz", "wb") as f:
            f.write(data)
    rows = build_manifest(spark, S.load_events(spark, tmp_dir, hash_bytes=True)).collect()
    assert len(rows) == 4 and {(r["raw_content"], r["record_count"]) for r in rows} == {(body.decode(), 2)}


def test_header_is_bounded_and_may_hold_line_ends(monkeypatch):
    g, header, ok, _, sep, padded = S._probe_stream(io.BytesIO(b'a,"b\nc"\r1,2\r'), True, False)
    assert (g, header, ok, sep, padded) == (False, ["a", "b\nc"], True, "\r", False)
    monkeypatch.setattr(S, "HEADER_BYTES", 1000)
    assert S._probe_stream(io.BytesIO(b"x" * 5000), True, True, chunk=100)[1] == []
    # A member that inflates to much more than a chunk is complete all the same.
    big = gzip.compress(b"a,b\n" + b"0" * 5_000_000)
    assert S._probe_stream(io.BytesIO(big), True, False, chunk=64)[2] is True
    assert S._probe_stream(io.BytesIO(big[:-1]), True, False, chunk=64)[2] is False
    assert len(b"".join(blocks.inflated(zlib.decompressobj(31), big, 1000))) == 5_000_004


def test_listing_of_files_and_folders(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/x/y")
    for name in ("a", "x/b", "x/y/.c", "x/y/d#e%41"):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(name)
    rows = L.list_files(spark, [tmp_dir, f"{tmp_dir}/x/b"]).collect()
    assert sorted((r["path"].removeprefix(f"file:{tmp_dir}/"), r["length"]) for r in rows) == sorted(
        [("a", 1), ("x/b", 3), ("x/b", 3), ("x/y/.c", 6), ("x/y/d#e%41", 10)])
    when = {r["path"]: r["modification_time"] for r in rows}[f"file:{tmp_dir}/a"]
    assert abs(when.replace(tzinfo=dt.timezone.utc).timestamp() - os.path.getmtime(f"{tmp_dir}/a")) < 3600 * 24
    assert spark.read.format("ebbflow_files").option("roots", f'["{tmp_dir}"]').load().count() == 4
    with pytest.raises(Exception):
        S.list_source_files(spark, f"{tmp_dir}/nowhere").collect()
    assert L.can_list(tmp_dir) and not L.can_list(f"{tmp_dir}/no*")


def test_roots_without_a_scheme_are_of_the_default_file_system(spark):
    assert L.qualified(spark, "/tmp/a b%41") == "file:/tmp/a b%41"
    assert L.qualified(spark, "s3a://bucket/x") == "s3a://bucket/x" and L.qualified(spark, "file:/x") == "file:/x"


def test_other_schemes_open_through_arrow(tmp_dir):
    with open(f"{tmp_dir}/f", "w") as f:
        f.write("abc")
    # Arrow knows local files as a scheme too: the same code that opens s3:// and hdfs:// paths.
    fs, inside, prefix, base = blocks.arrow_place(f"file://{tmp_dir}/f")
    with fs.open_input_file(inside) as f:
        assert f.read() == b"abc"
    assert prefix + inside[len(base):] == f"file://{tmp_dir}/f"
    assert not blocks.reachable("nosuch://bucket/key")


def test_file_parts_hold_files_of_any_size(spark, tmp_dir):
    data = np.random.default_rng(1).bytes(10_000)
    with open(f"{tmp_dir}/f", "wb") as f:
        f.write(data)
    files = spark.createDataFrame([(f"file:{tmp_dir}/f", len(data))], "source_path string, length long")
    parts = blocks.file_parts(files, 999).orderBy("part").collect()
    assert len(parts) == 11 and b"".join(r["content"] for r in parts) == data
