"""Tables kept up by runs: rolling aggregate, incremental marts, compaction, dead letters; types and rejected rows."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ebbflow.config import RunClock
from ebbflow.operators import aggregates as G
from ebbflow.operators import dead_letters as DL
from ebbflow.operators import distinct_state as DS
from ebbflow.operators import events as E
from ebbflow.operators import governance as V
from ebbflow.operators import overlap as OV
from ebbflow.operators import reports as P
from ebbflow.operators import routing as R
from ebbflow.operators import types as T
from ebbflow.plans import event_lake as EL
from ebbflow.sinks import compact as CP
from ebbflow.sinks import curve as CU
from ebbflow.sinks import parquet as W
from ebbflow.sinks import quarantine as QN
from ebbflow.sinks.versions import Commit, VersionedTable
from ebbflow.streaming import incremental as INC
from ebbflow.streaming import rolling as ROLL


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


# ------------------------------------------------------------------ rolling
def events(spark, days, clock):
    raw = spark.createDataFrame(
        [(f"u{i % 3}", str(1704067200 + d * 86400 + i), str(1704067200), "event",
          '{"adjust_event_name": "ad_impression", "ad_revenue": "%d.25"}' % i, "US", "ios", None, "1", "s3://b/t1_2024-01-01T00.csv.gz")
         for i, d in enumerate(days)],
        "adid string, created_at string, installed_at string, activity_kind string, publisher_parameters string, country string, "
        "os_name string, device_type string, app_version_short string, filename string")
    return E.process_events(E.attach_tenant(raw), clock)


def test_rolling_equals_full_recompute(spark, tmp_dir):
    clocks = [RunClock("2024-01-20 00:00:00"), RunClock("2024-02-20 00:00:00"), RunClock("2024-02-21 00:00:00")]
    batches = [[0, 1, 5, 19, 19], [19, 40, 30, 22, 19], [50, 20, 21, 41, 0]]  # days since 2024-01-01, late ones among them
    root, seen = f"{tmp_dir}/state", []
    for n, (clock, days) in enumerate(zip(clocks, batches)):
        seen += days
        own = events(spark, days, clock)
        assert ROLL.merge_batch(spark, root, own, clock, f"b{n}")
        assert not ROLL.merge_batch(spark, root, own, clock, f"b{n}")  # repeated after a failure
        # Everything so far in one run: revenue goes by the row's place in its batch.
        whole = None
        for k in range(n + 1):
            part = events(spark, batches[k], clock)
            whole = part if whole is None else whole.unionByName(part)
        full = G.ad_preaggregate(whole, clock).drop("_time")
        assert rows_of(ROLL.read_rolling(spark, root).drop("_time")) == rows_of(full)
    commit = VersionedTable(spark, root, "date").current()
    assert min(commit.folders) >= "2024-01-22" and commit.applied == ["b0", "b1", "b2"]


def test_rolling_reads_only_touched_dates_and_one_writer_wins(spark, tmp_dir):
    clock, root = RunClock("2024-01-20 00:00:00"), f"{tmp_dir}/state"
    ROLL.merge_batch(spark, root, events(spark, [1, 2, 3], clock), clock, "a")
    before = VersionedTable(spark, root, "date").current()
    ROLL.merge_batch(spark, root, events(spark, [2], clock), clock, "b")
    table = VersionedTable(spark, root, "date")
    after = table.current()
    assert [d for d in before.folders if before.folders[d] != after.folders[d]] == ["2024-01-03"]
    with pytest.raises(Exception):
        table.commit(before, before.folders, ["late"])  # someone has committed since
    assert VersionedTable(spark, f"{tmp_dir}/none", "date").current() == Commit()
    assert ROLL.read_rolling(spark, root, RunClock("2024-03-20 00:00:00")).count() == 0


# ------------------------------------------------------------------ incremental marts
def manifest(spark, rows):
    return spark.createDataFrame(rows, "file_name string, load_timestamp timestamp, file_hash string, record_count bigint, raw_content string")


def mart_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_incremental_marts_rewrite_only_what_changed(spark, tmp_dir):
    day = [dt.datetime(2024, 1, d, 12) for d in range(1, 32)]
    first, second = RunClock("2024-01-27 15:00:00"), RunClock("2024-01-28 15:00:00")
    one = [("a", day[24], "h", 5, "x,y"), ("b", day[25], "h", 5, "x,y"), ("c", day[25], "h", 0, "x,y"), ("d", day[21], "h", 7, "x,y")]
    run = EL.run_governance(spark, manifest(spark, one), first, f"{tmp_dir}/m", "/dlq", incremental=True)
    before = mart_files(run.processed_path)
    # b has another count, e is new, f comes twice, a and c are unchanged, d left the window at the next run.
    two = [("a", day[24], "h", 5, "x,y"), ("b", day[25], "h", 6, "x,y"), ("c", day[25], "h", 0, "x,y"), ("e", day[26], "h", 1, "x,y"),
           ("f", day[26], "h", 2, "x,y"), ("f", day[26], "h", 3, "x,y")]
    run = EL.run_governance(spark, manifest(spark, two), second, f"{tmp_dir}/m", "/dlq", incremental=True)
    got = {r["file_name"]: (r["record_count"], r["inserted_at"].day, r["updated_at"].day) for r in run.processed.collect()}
    assert got == {"a": (5, 27, 27), "b": (6, 27, 28), "d": (7, 27, 27), "e": (1, 28, 28), "f": (3, 28, 28)}
    after = mart_files(run.processed_path)
    assert {p: t for p, t in before.items() if "2024-01-25" in p or "2024-01-22" in p}.items() <= after.items()
    assert [r["file_name"] for r in run.failed.collect()] == ["c"] and run.failed.first()["failure_date"].day == 27
    unchanged = mart_files(f"{tmp_dir}/m")
    EL.run_governance(spark, manifest(spark, two), RunClock("2024-01-28 16:00:00"), f"{tmp_dir}/m", "/dlq", incremental=True)
    assert mart_files(f"{tmp_dir}/m") == unchanged
    # A file that is sent again on another day moves to that day's partition, and the emptied one goes.
    three = [("a", day[27], "h", 5, "x,y")]
    run = EL.run_governance(spark, manifest(spark, three), second, f"{tmp_dir}/m", "/dlq", incremental=True)
    assert {r["file_name"]: r["load_date"].day for r in run.processed.collect()}["a"] == 28
    assert not os.path.exists(f"{run.processed_path}/load_date=2024-01-25")


# ------------------------------------------------------------------ compaction
def small_table(spark, path):
    spark.range(4000).select(F.concat(F.lit("t "), (F.col("id") % 3).cast("string")).alias("table_name"), (F.col("id") % 2).alias("date"),
                             F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(12).write.partitionBy("table_name", "date").parquet(path)


def test_compaction_keeps_rows_and_then_does_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    small_table(spark, path)
    before, n = rows_of(spark.read.parquet(path)), len(mart_files(path))
    sizes = sorted(os.path.getsize(f) for f in mart_files(path))
    made = CP.compact(spark, path, target_bytes=4 * sizes[-1])
    files = mart_files(path)
    assert rows_of(spark.read.parquet(path)) == before and made[0] == n == 72
    assert len(files) == made[1] < n / 2 and not [f for f in os.listdir(path) if f.startswith("_comp")]
    CP.compact(spark, path, target_bytes=4 * sizes[-1])
    again = mart_files(path)
    assert CP.compact(spark, path, target_bytes=2 * sizes[0]) == (0, 0) and mart_files(path) == again
    assert rows_of(spark.read.parquet(path)) == before


def test_compaction_that_was_cut_short_is_completed(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    small_table(spark, path)
    before = rows_of(spark.read.parquet(path))
    calls = {"n": 0}
    real = CP.finish_swaps

    def stop(*a):
        calls["n"] += 1
        return real(*a) if calls["n"] == 1 else 0

    monkeypatch.setattr(CP, "finish_swaps", stop)
    CP.compact(spark, path, target_bytes=1 << 20)  # written, not swapped
    assert rows_of(spark.read.parquet(path)) == before
    assert real(spark, path) == 6 and rows_of(spark.read.parquet(path)) == before and len(mart_files(path)) == 6
    os.makedirs(f"{path}/{CP.MARKER}-dead/data")  # a writer that died
    assert real(spark, path) == 0 and not os.path.exists(f"{path}/{CP.MARKER}-dead")


# ------------------------------------------------------------------ dead letters
def test_dead_letter_life(spark):
    def at(h):
        return dt.datetime(2024, 1, 1, h)

    rows = [("once", at(1), "FAILED", "A"), ("again", at(1), "FAILED", "A"), ("again", at(2), "FAILED", "B"),
            ("fixed", at(1), "FAILED", "A"), ("fixed", at(3), "LOADED", None), ("broken", at(1), "LOADED", None), ("broken", at(2), "FAILED", "C"),
            ("fine", at(1), "LOADED", None), ("back", at(1), "FAILED", "A"), ("back", at(2), "LOADED", None), ("back", at(3), "FAILED", "D"),
            ("tie", at(2), "FAILED", "A"), ("tie", at(2), "LOADED", None)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "file_name string, at timestamp, event string, reason string")
    expected = {"once": ("FAILED", 1, "A"), "again": ("RETRIED", 2, "B"), "fixed": ("RESOLVED", 1, "A"), "broken": ("FAILED", 1, "C"),
                "back": ("RETRIED", 2, "D"), "tie": ("FAILED", 1, "A")}
    whole = DL.fold(frame)
    parts = DL.merge(DL.fold(frame.where("hash(reason, event) % 2 = 0")).unionByName(DL.fold(frame.where("hash(reason, event) % 2 <> 0"))))
    for states in (whole, parts):
        got = {r["file_name"]: (r["state"], r["failures"], r["failure_reason"]) for r in DL.dead_letters(states).collect()}
        assert got == expected


def test_repaired_file_resolves_its_row(spark):
    clock = RunClock("2024-01-31 15:00:00")
    bad = V.failed_files(V.validate_files(V.stage_raw_files(manifest(spark, [("z", dt.datetime(2024, 1, 30), "h", 0, "a,b"), ("y", dt.datetime(2024, 1, 30), "h", 0, "a,b")]),
                                                            clock), clock), clock, "/dlq")
    good = V.processed_files(V.validate_files(V.stage_raw_files(manifest(spark, [("z", dt.datetime(2024, 1, 31), "h2", 3, "a,b")]), clock), clock), clock)
    done = DL.resolve(bad, DL.fold(DL.file_events(good, bad)))
    assert {r["file_name"]: r["is_resolved"] for r in done.collect()} == {"z": True, "y": False} and done.columns == bad.columns


# ------------------------------------------------------------------ types
def test_types_merge(spark):
    rows = [("1", "1.5", "true", "2024-02-29", "2024-01-01 10:00:00", "x", "", "1"), ("-7", "2", "FALSE", "2024-01-31", "2024-01-02", "1", None, "1e5"),
            ("", ".5e3", None, "", "2024-01-01T10:00:00.5", "2", "", "2024-02-30")]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(8)) + "")
    expected = {"c0": "bigint", "c1": "double", "c2": "boolean", "c3": "date", "c4": "timestamp", "c5": "string", "c6": "string", "c7": "string"}
    whole = T.column_type_bits(df)
    parts = T.column_type_bits(df.where("c0 = '1'")).unionByName(T.column_type_bits(df.where("c0 <> '1'")))
    for bits in (whole, T.merge_type_bits(parts)):
        types = {r["column_name"]: r["inferred_type"] for r in T.inferred_types(bits).collect()}
        assert types == expected
    typed = T.apply_types(df, types)
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "boolean", "date", "timestamp", "string", "string", "string"]
    assert [r["c0"] for r in typed.collect()] == [1, -7, None]
    assert {r["inferred_type"] for r in T.inferred_types(T.column_type_bits(df.where("false"))).collect()} == {"string"}


# ------------------------------------------------------------------ any header, rejected rows, reports
INTERNAL = ["suffix", "allowed", "filter_value", "filter_column", "reason", "batch_id", "table_name", "value", "found", "__rule_value",
            "__rules_found", "__n", "n", "prefix_2", "row", "rank", "user.id", "status", "k0", "__malformed", "path"]


def odd_source(tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for name, tenant in (("t_2024-01-01T00", "t"), ("nomatch", "")):
        with open(f"{src}/{name}.csv.gz", "w") as f:
            f.write("adid,created_at,activity_kind,publisher_parameters," + ",".join(INTERNAL) + "\n")
            f.write("u1,1704067200, Session ,{}," + ",".join(f"s{i}" for i in range(len(INTERNAL))) + "\n")
            f.write("u2,oops,install,{}," + "," * (len(INTERNAL) - 1) + "\n")
            f.write("u3,1704067200,install,nojson," + "," * (len(INTERNAL) - 1) + "\n")
    return src


def test_lake_survives_any_header(spark, tmp_dir):
    src = odd_source(tmp_dir)
    run = EL.run_event_lake(spark, src, f"{tmp_dir}/out", RunClock("2024-02-10 00:00:00"), "/dlq")
    m = run.metrics.first()
    assert (m["failed_writes"], m["partitioned_rows_written"], m["rows_rejected"], m["rows_unrouted"]) == ([], 3, 4, 0)
    routed = spark.read.parquet(run.events_path).where("adid = 'u1'").first()
    assert routed["table_name"] == "t_session" and routed["table_name_2"] == f"s{INTERNAL.index('table_name')}"
    assert routed["suffix"] == "s0" and routed["reason_2"] == f"s{INTERNAL.index('reason')}" and routed["user.id"] == f"s{INTERNAL.index('user.id')}"
    aside = spark.read.parquet(f"{tmp_dir}/out/_quarantine_no_tenant").where("adid = 'u1'").first()
    assert aside["reason"] == "NO_TENANT" and aside["allowed"] == "s1"
    rejected = spark.read.parquet(f"{tmp_dir}/out/_quarantine_rejected").where("prefix = 't'").collect()
    assert sorted((r["adid"], r["reject_reason"]) for r in rejected) == [("u2", "BAD_CREATED_AT"), ("u3", "BAD_JSON")]


def test_bad_rows_by_mode(spark, tmp_dir):
    src = odd_source(tmp_dir)
    clock = RunClock("2024-02-10 00:00:00")
    run = EL.run_event_lake(spark, src, f"{tmp_dir}/q", clock, "/dlq", on_bad_row="quarantine")
    assert [r["adid"] for r in spark.read.parquet(run.events_path).collect()] == ["u1"]
    with pytest.raises(ValueError, match="do not parse"):
        EL.run_event_lake(spark, src, f"{tmp_dir}/f", clock, "/dlq", on_bad_row="fail")
    assert not os.path.exists(f"{tmp_dir}/f/events")
    with pytest.raises(ValueError):
        EL.run_event_lake(spark, src, f"{tmp_dir}/x", clock, "/dlq", on_bad_row="other")


def test_stream_survives_any_header_and_ingests_hidden_files(spark, tmp_dir):
    src = odd_source(tmp_dir)
    with open(f"{src}/_h_2024-01-01T00.csv.gz", "w") as f:
        f.write("adid,created_at,activity_kind\nu9,1704067200,session\n")
    args = (spark, src, f"{tmp_dir}/out", f"{tmp_dir}/ck", RunClock("2024-02-10 00:00:00"), "/dlq")
    INC.ingest_new_files(*args, route=True, normalize_activity=True, route_empty_tenant=False)
    assert INC.ingest_new_files(*args, route=True) == 0
    rows = INC.read_routed(spark, f"{tmp_dir}/out").collect()
    assert sorted((r["adid"], r["table_name"]) for r in rows) == [("u1", "t_session"), ("u2", "t_install"), ("u3", "t_install"), ("u9", "_h_session")]
    assert [r["batch_id_2"] for r in rows if r["adid"] == "u1"] == [f"s{INTERNAL.index('batch_id')}"]
    assert spark.read.parquet(f"{tmp_dir}/out/_no_tenant").count() == 3


def test_routing_with_a_source_table_name(spark):
    df = spark.createDataFrame([("t", "session", None, "own", "x")], "prefix string, activity_kind string, pp_event_name string, table_name string, suffix string")
    rules = R.RuleSet([("session", "activity_kind", "session", None), ("other", "activity_kind", "session", ["z"])])
    assert [r["table_name"] for r in R.route_events(df, rules).collect()] == ["t_session"]
    assert R.unrouted_rows(df, rules).first()["rows_unrouted"] == 0


def test_undated_rows_of_both_sides_stay_apart(spark):
    good = spark.createDataFrame([(None, 4)], "load_date date, record_count bigint")
    bad = spark.createDataFrame([(None, "A")], "failed_timestamp timestamp, failure_reason string")
    rows = P.processing_stats(good, bad)
    assert sorted((r["total_files"], r["success_rate"]) for r in rows.collect()) == [(1, 0.0), (1, 100.0)]
    assert "NestedLoop" not in rows._jdf.queryExecution().executedPlan().toString()


def test_dedupe_latest_with_alike_rows_and_null_keys(spark):
    ts = dt.datetime(2024, 1, 1)
    rows = [("a", ts, "h", 1, "x"), ("a", ts, "h", 1, "x"), ("a", ts, "g", 2, "y"), (None, ts, "h", 1, "x"), (None, None, None, None, None), ("b", None, "h", 1, None)]
    got = V.dedupe_latest(manifest(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(r) for r in [rows[0], rows[3], rows[5]])
    plan = V.dedupe_latest(manifest(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan


def test_files_too_long_for_a_cell_are_kept_in_parts(spark, tmp_dir):
    data = bytes(range(256)) * 40
    with open(f"{tmp_dir}/big_2024-01-01T00.csv.gz", "wb") as f:
        f.write(b"\x1f\x8b" + data)
    from ebbflow.sources import files as S

    files = S.classify_files(S.probe_files(S.list_source_files(spark, tmp_dir)))
    q = QN.quarantine_frame(files, RunClock("2024-02-10 00:00:00"), "/dlq")
    assert QN.with_content(spark, q, most_bytes=1000).first()["content"] is None
    assert QN.write_parts(spark, q, f"{tmp_dir}/parts", "r", most_bytes=1000, part_bytes=700) == 1
    parts = spark.read.parquet(f"{tmp_dir}/parts").orderBy("part").collect()
    assert b"".join(r["content"] for r in parts) == b"\x1f\x8b" + data
    assert QN.with_content(spark, q).first()["content"] == b"\x1f\x8b" + data


# ------------------------------------------------------------------ curve, overlap, distinct state
def test_curve_lets_every_column_skip_files(spark, tmp_dir):
    df = spark.range(40_000).select(F.lit("2024-01-01").alias("d"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("a"),
                                    F.format_string("f%05d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000))).alias("b"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        CU.write_curve(df, f"{tmp_dir}/z", "d", ["a", "b"], num_partitions=64)
        W.write_clustered(df.repartitionByRange(64, "a", "b"), f"{tmp_dir}/sorted", "d", ["a", "b"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def read(path, column, value):
        """Share of files whose range holds the value: those that statistics cannot skip."""
        ranges = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        return sum(r["lo"] <= value <= r["hi"] for r in ranges) / len(ranges)

    shares = {c: read(f"{tmp_dir}/z", c, v) for c, v in (("a", 5000), ("b", "f05000"))}
    assert max(shares.values()) < 0.4 and read(f"{tmp_dir}/sorted", "b", "f05000") > 0.9
    assert rows_of(spark.read.parquet(f"{tmp_dir}/z").drop("d")) == rows_of(df.drop("d"))


def test_z_key_interleaves_bits(spark):
    r = spark.range(1).select(CU.z_key([F.lit(5).cast("long"), F.lit(3).cast("long")], 3).alias("k"), CU.rank(F.lit(None).cast("long"), [1, 2]).alias("r"),
                              CU.rank(F.lit(2).cast("long"), [1, 2, 7]).alias("s")).first()
    assert (r["k"], r["r"], r["s"]) == (0b100111, 0, 2)


def test_overlap_follows_inserted_lines(spark):
    rng = random.Random(8)
    lines = [f"{rng.random()},{i}" for i in range(200)]
    ts = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    rows = [("a", ts[0], "h", 1, "\n".join(lines)), ("b", ts[1], "h", 1, "\n".join(lines[:90] + ["new,1"] + lines[90:])),
            ("c", ts[2], "h", 1, "\n".join(f"{rng.random()},x" for _ in range(50))), ("d", ts[3], "h", 1, None), ("e", ts[3], "h", 1, "")]
    found = OV.overlapping_files(OV.file_chunks(manifest(spark, rows))).collect()
    assert [(r["file_name"], r["earlier_file"]) for r in found] == [("b", "a")]
    assert found[0]["shared_chunks"] > 0.8 * found[0]["file_chunks"]


def test_distinct_counts_merge_exactly(spark):
    rng = random.Random(9)
    rows = [(f"f{rng.randint(0, 300)}", dt.datetime(2024, 1, rng.randint(1, 6), 3), rng.choice(["A", "B", None]), rng.choice([None, 1, 2, 5]), rng.random() < 0.1)
            for _ in range(2000)] + [(None, dt.datetime(2024, 1, 1), "A", 1, False)]
    failed = spark.createDataFrame(rows, "file_name string, failed_timestamp timestamp, failure_reason string, record_count bigint, is_resolved boolean")
    known, states = None, []
    for day in range(1, 7):
        own = failed.where(F.dayofmonth("failed_timestamp") == day)
        known = DS.number_names(own.select("file_name"), known)
        known = spark.createDataFrame(known.collect(), known.schema)
        states.append(DS.failure_state(own, known))
    state = states[0]
    for s in states[1:]:
        state = state.unionByName(s)
    assert rows_of(DS.dlq_summary(state)) == rows_of(P.dlq_summary(failed))
    assert known.count() == known.select("part", "number").distinct().count() == known.select("file_name").distinct().count()
