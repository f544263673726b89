import gzip
import os

import pytest
from pyspark.sql import functions as F

from ebbflow.config import RunClock
from ebbflow.operators import governance as V
from ebbflow.plans import event_lake as EL
from ebbflow.sinks import parquet as W
from ebbflow.sinks import quarantine as QN
from ebbflow.sources import files as S
from ebbflow.sources.manifest import build_manifest
from ebbflow.streaming import incremental as INC

CLOCK = RunClock("2024-02-10 00:00:00")


def _files(d):
    os.makedirs(d, exist_ok=True)
    # plain text despite the .gz name; quoting, doubled quotes, newline in quotes, short and long rows
    with open(f"{d}/ta_2024-01-01T00.csv.gz", "w") as f:
        f.write('{adid},{created_at},{Country}\nu1,1704067200,US\nu2,"x""y",DE\nu3,2\nu4,3,TR,extra\n'
                '"u5","17040\n67200","A,B"\n')
    with gzip.open(f"{d}/tb_2024-01-02T00.csv.gz", "wt") as f:   # real gzip, other header order + extra column
        f.write("created_at,adid,{extra}\n1704067200,u9,e\n")
    open(f"{d}/tc_2024-01-03T00.csv.gz", "w").close()              # zero bytes
    with open(f"{d}/td_2024-01-03T00.csv.gz", "w") as f:           # header only
        f.write("adid,created_at\n")
    with open(f"{d}/te_2024-01-04T00.csv.gz", "wb") as f:          # truncated gzip
        f.write(gzip.compress(b"adid,created_at\n" + b"u,1\n" * 500)[:40])
    with open(f"{d}/ignored.csv", "w") as f:                       # wrong suffix: not listed
        f.write("a,b\n1,2\n")


def test_listing_probe_classify(spark, tmp_dir):
    _files(tmp_dir)
    listing = S.list_source_files(spark, tmp_dir)
    names = sorted(r["file_name"] for r in listing.collect())
    assert names == ["ta_2024-01-01T00.csv.gz", "tb_2024-01-02T00.csv.gz", "tc_2024-01-03T00.csv.gz",
                     "td_2024-01-03T00.csv.gz", "te_2024-01-04T00.csv.gz"]
    files = {r["file_name"]: r for r in S.classify_files(S.probe_files(listing)).collect()}
    assert files["ta_2024-01-01T00.csv.gz"]["status"] == "OK" and not files["ta_2024-01-01T00.csv.gz"]["is_gzip"]
    assert files["tb_2024-01-02T00.csv.gz"]["status"] == "OK" and files["tb_2024-01-02T00.csv.gz"]["is_gzip"]
    assert files["tc_2024-01-03T00.csv.gz"]["status"] == "EMPTY_FILE"
    assert files["td_2024-01-03T00.csv.gz"]["status"] == "OK"
    assert files["te_2024-01-04T00.csv.gz"]["status"] == "CORRUPT_GZIP"


def test_scan_union_by_name_quoting_and_malformed(spark, tmp_dir):
    _files(tmp_dir)
    res = S.load_events(spark, tmp_dir)
    rows = {r["adid"]: r for r in res.rows.collect()}
    assert set(rows) == {"u1", "u2", "u5", "u9"}
    assert rows["u2"]["created_at"] == 'x"y'
    assert rows["u5"]["created_at"] == "17040\n67200" and rows["u5"]["country"] == "A,B"
    assert rows["u9"]["country"] is None and rows["u9"]["extra"] == "e"      # by name, missing -> NULL
    assert rows["u1"]["extra"] is None and rows["u1"]["prefix"] == "ta"
    assert sorted(r["_corrupt_record"] for r in res.bad_rows.collect()) == ["u3,2", "u4,3,TR,extra"]


def test_source_window_and_empty_input(spark, tmp_dir):
    _files(tmp_dir)
    only_b = S.load_events(spark, tmp_dir, date="2024-01-02")
    assert [r["adid"] for r in only_b.rows.collect()] == ["u9"]
    none = S.load_events(spark, tmp_dir, date="2030-01-01")
    assert none.rows.count() == 0 and "created_at" in none.rows.columns


def test_quarantine_content(spark, tmp_dir):
    _files(tmp_dir)
    files = S.classify_files(S.probe_files(S.list_source_files(spark, tmp_dir)))
    q = QN.with_content(spark, QN.quarantine_frame(files, CLOCK, "/dlq")).collect()
    got = sorted((r["file_name"], r["reason"], len(r["content"])) for r in q)
    assert got == [("tc_2024-01-03T00.csv.gz", "EMPTY_FILE", 0), ("te_2024-01-04T00.csv.gz", "CORRUPT_GZIP", 40)]


def test_dynamic_overwrite_keeps_other_partitions_and_is_idempotent(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    a = spark.createDataFrame([("t1", "2024-01-01", 1), ("t1", "2024-01-02", 2)], "table_name string, date string, v int")
    W.write_partitioned(a, out, ["table_name", "date"])
    b = spark.createDataFrame([("t1", "2024-01-02", 3)], "table_name string, date string, v int")
    W.write_partitioned(b, out, ["table_name", "date"])
    W.write_partitioned(b, out, ["table_name", "date"])
    got = sorted((str(r["date"]), r["v"]) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 3)]


def test_hot_partition_is_split_over_files(spark, tmp_dir):
    out = f"{tmp_dir}/hot"
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("table_name"),
        F.col("id"))
    W.write_partitioned(df, out, ["table_name"], target_rows_per_file=5000, num_partitions=8)
    hot = [f for f in os.listdir(f"{out}/table_name=hot") if f.endswith(".parquet")]
    cold = [f for f in os.listdir(f"{out}/table_name=cold") if f.endswith(".parquet")]
    assert len(hot) >= 3 and len(cold) >= 1
    assert spark.read.parquet(out).count() == 30000


def test_event_lake_end_to_end(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _files(src)
    run = EL.run_event_lake(spark, src, f"{tmp_dir}/out", CLOCK, "/dlq")
    m = run.metrics.first()
    assert (m["files_total"], m["files_ok"], m["files_failed"]) == (5, 3, 2)
    assert m["rows_read"] == 4 and m["rows_malformed"] == 2
    assert m["failed_writes"] == []
    q = {r["file_name"]: r for r in spark.read.parquet(run.quarantine_path).collect()}
    assert len(q) == 2 and len(q["te_2024-01-04T00.csv.gz"]["content"]) == 40


def test_incremental_ingest_picks_up_only_new_files(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _files(src)
    assert INC.ingest_new_files(spark, src, out, ck, CLOCK, "/dlq") >= 1
    n1 = INC.read_ingested(spark, out).count()
    assert INC.ingest_new_files(spark, src, out, ck, CLOCK, "/dlq") == 0
    with open(f"{src}/tf_2024-01-05T00.csv.gz", "w") as f:
        f.write("adid,created_at,activity_kind\nu7,1704067200,session\n")
    assert INC.ingest_new_files(spark, src, out, ck, CLOCK, "/dlq", route=True) == 1
    assert INC.read_ingested(spark, out).count() == n1 + 1
    routed = spark.read.parquet(f"{out}/routed").collect()
    assert [(r["adid"], r["table_name"]) for r in routed] == [("u7", "tf_session")]


def test_event_lake_table_folders(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _files(src)
    with open(f"{src}/tf_2024-01-05T00.csv.gz", "w") as f:
        f.write("adid,created_at,activity_kind\nu7,1704067200,session\n")
    run = EL.run_event_lake(spark, src, f"{tmp_dir}/out", CLOCK, "/dlq", events_layout="table_folders")
    assert run.metrics.first()["failed_writes"] == []
    assert os.listdir(f"{run.events_path}/tf_session") == ["date=2024-01-01"]


def test_event_lake_on_empty_folder(spark, tmp_dir):
    src = f"{tmp_dir}/empty"
    os.makedirs(src)
    run = EL.run_event_lake(spark, src, f"{tmp_dir}/out", CLOCK, "/dlq")
    m = run.metrics.first()
    assert (m["files_total"], m["rows_read"], m["partitioned_rows_written"]) == (0, 0, 0)


def test_required_columns_quarantine(spark, tmp_dir):
    _files(tmp_dir)
    res = S.load_events(spark, tmp_dir, required_columns=["adid", "created_at", "country"])
    st = {r["file_name"]: r["status"] for r in res.files.collect()}
    assert st["ta_2024-01-01T00.csv.gz"] == "OK"
    assert st["tb_2024-01-02T00.csv.gz"] == "MISSING_COLUMNS: country"
    assert sorted(r["adid"] for r in res.rows.collect()) == ["u1", "u2", "u5"]


def test_good_row_count_agrees_with_collect(spark, tmp_dir):
    # Column pruning must not change which rows count as malformed.
    _files(tmp_dir)
    res = S.load_events(spark, tmp_dir)
    assert res.rows.count() == len(res.rows.collect()) == 4
    assert res.rows.select("adid").count() == 4
    assert res.bad_rows.count() == 2


def test_source_window_hour_and_tenant(spark, tmp_dir):
    _files(tmp_dir)
    listing = S.list_source_files(spark, tmp_dir)
    assert S.source_window(listing, hour="00").count() == 5
    assert S.source_window(listing, hour="13").count() == 0
    names = [r["file_name"] for r in S.source_window(listing, tenants=["tb"]).collect()]
    assert names == ["tb_2024-01-02T00.csv.gz"]


def test_crlf_bom_and_duplicate_headers(spark, tmp_dir):
    with open(f"{tmp_dir}/tw_2024-01-01T00.csv.gz", "wb") as f:
        f.write("﻿{adid},Country,{country},created_at\r\nu1,US,us,1704067200\r\n\"u2\",\"D\r\nE\",de,1704067201\r\n"
                .encode("utf-8"))
    res = S.load_events(spark, tmp_dir)
    assert res.rows.columns[:4] == ["adid", "country", "country_2", "created_at"]
    rows = {r["adid"]: r for r in res.rows.collect()}
    assert rows["u1"]["country"] == "US" and rows["u1"]["country_2"] == "us"
    assert rows["u1"]["created_at"] == "1704067200"          # no trailing \r
    # newline kept inside quotes (the CSV parser normalises CRLF there to LF)
    assert rows["u2"]["country"] == "D\nE"


def test_shuffle_partitions_only_raised(spark):
    from ebbflow.session import ensure_shuffle_partitions
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ensure_shuffle_partitions(spark, 1024) == before
    assert ensure_shuffle_partitions(spark, 64 * 128 * 1024 * 1024) == max(before, 64)
    spark.conf.set("spark.sql.shuffle.partitions", str(before))


def test_odd_file_names_are_read_as_they_are(spark, tmp_dir):
    names = ["my app", "a#b", "a%41+b", "a[1]{x}"]
    for n in names:
        with open(f"{tmp_dir}/{n}_2024-01-01T00.csv.gz", "w") as f:
            f.write("adid,created_at,activity_kind\nu1,1704067200,session\nu2,1704067200,session\n")
    open(f"{tmp_dir}/my app_2024-01-02T00.csv.gz", "w").close()
    scan = S.load_events(spark, tmp_dir, hash_bytes=True)
    assert {r["file_name"]: r["status"] for r in scan.files.collect()} == {
        **{f"{n}_2024-01-01T00.csv.gz": "OK" for n in names}, "my app_2024-01-02T00.csv.gz": "EMPTY_FILE"}
    assert {r["prefix"]: r["count"] for r in scan.rows.groupBy("prefix").count().collect()} == dict.fromkeys(names, 2)
    for content in (True, False):
        m = V.stage_raw_files(build_manifest(spark, scan, include_content=content), CLOCK, retention_days=100_000)
        v = {r["file_name"]: (r["record_count"], r["validation_error"]) for r in V.validate_files(m, CLOCK).collect()}
        assert v == {**{f"{n}_2024-01-01T00.csv.gz": (2, None) for n in names}, "my app_2024-01-02T00.csv.gz": (None, "INVALID_CONTENT")}
    cut = S.source_window(scan.files, date="2024-01-02")
    assert [r["file_name"] for r in QN.with_content(spark, QN.quarantine_frame(cut, CLOCK, "/dlq")).collect()] == ["my app_2024-01-02T00.csv.gz"]


def test_window_goes_by_the_file_name(spark, tmp_dir):
    d = f"{tmp_dir}/x_2024-01-09T00"
    os.makedirs(d)
    for n in ("t_2024-01-01T1430", "t_2024-01-01T14", "t_2024-01-01T09", "u_2024-01-09T09"):
        with open(f"{d}/{n}.csv.gz", "w") as f:
            f.write("adid\nu1\n")
    listing = S.list_source_files(spark, tmp_dir)

    def names(**kw):
        return sorted(r["file_name"].split(".")[0] for r in S.source_window(listing, **kw).collect())

    assert names(date="2024-01-09") == ["u_2024-01-09T09"]
    assert names(hour="1430") == ["t_2024-01-01T1430"]
    assert names(hour=14) == ["t_2024-01-01T14", "t_2024-01-01T1430"]
    assert names(hour=9, tenants=["t"]) == ["t_2024-01-01T09"]
    assert sorted(r["filename"].rsplit("/", 1)[1] for r in S.load_events(spark, tmp_dir, date="2024-01-01", hour="14").rows.collect()) == [
        "t_2024-01-01T14.csv.gz", "t_2024-01-01T1430.csv.gz"]
    for bad in ("24", "1460", "x", ""):
        with pytest.raises(ValueError):
            S.source_window(listing, hour=bad)


def test_odd_headers(spark, tmp_dir):
    with open(f"{tmp_dir}/t_2024-01-01T00.csv.gz", "w") as f:
        f.write("adid,created_at,activity_kind,user.id,date,filename,prefix,\nu1,1704067200,session,a,b,c,d,e\n")
    run = EL.run_event_lake(spark, tmp_dir, f"{tmp_dir}-out", CLOCK, "/dlq")
    m = run.metrics.first()
    assert m["failed_writes"] == [] and m["partitioned_rows_written"] == 1
    r = spark.read.parquet(run.processed_path).first()
    assert (r["user.id"], r["date_2"], r["filename_2"], r["prefix_2"], r["prefix"]) == ("a", "b", "c", "d", "t")


def test_failed_write_is_told_and_counts_nothing(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    os.makedirs(src)
    os.makedirs(out)
    with open(f"{src}/t_2024-01-01T00.csv.gz", "w") as f:
        f.write("adid,created_at,activity_kind\nu1,1704067200,session\n")
    with open(f"{out}/events", "w") as f:
        f.write("not a folder")
    run = EL.run_event_lake(spark, src, out, CLOCK, "/dlq")
    m = run.metrics.first()
    assert len(m["failed_writes"]) == 1 and m["failed_writes"][0].startswith("events t_session: ")
    assert (m["partitioned_rows_written"], m["tables_written"], m["failed_tables"]) == (0, 0, 1)
    assert [r["table_name"] for r in run.coverage.where("status = 'failed'").collect()] == ["t_session"]
    with pytest.raises(ValueError):
        EL.run_event_lake(spark, src, f"{out}2", CLOCK, "/dlq", events_layout="other")


def test_one_table_fails_alone(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "table_name string, v int")
    done = []

    def write(part):
        tables = sorted({r["table_name"] for r in part.collect()})
        if "b" in tables:
            raise OSError("no " + "x" * 1000)
        done.extend(tables)

    assert EL.isolated_write(df, write) == {"b": "OSError: no " + "x" * 1000} and done == ["a"]


def test_clustered_files_do_not_overlap(spark, tmp_dir):
    df = spark.range(20000).select(F.lit("2024-01-01").alias("d"), F.format_string("f%06d", F.col("id")).alias("name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        W.write_clustered(df, f"{tmp_dir}/c", "d", ["name"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = sorted((r["a"], r["b"]) for r in spark.read.parquet(f"{tmp_dir}/c").groupBy(F.input_file_name()).agg(
        F.min("name").alias("a"), F.max("name").alias("b")).collect())
    assert len(ranges) > 1 and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))


def test_new_checkpoint_counts_no_file_twice(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    _files(src)
    with open(f"{src}/tf_2024-01-05T00.csv.gz", "w") as f:
        f.write("adid,created_at,activity_kind,publisher_parameters\n"
                'u7,1706745600,event,"{""adjust_event_name"": ""ad_impression"", ""ad_revenue"": ""0.5""}"\n')
    for ck in ("ck1", "ck2", "ck2"):
        INC.ingest_new_files(spark, src, out, f"{tmp_dir}/{ck}", CLOCK, "/dlq")
        assert INC.read_ingested(spark, out).count() == 1
        assert [(r["ad_count"], r["ad_revenue"]) for r in INC.read_aggregates(spark, out).collect()] == [(1, 0.5)]
        q = spark.read.parquet(f"{out}/_quarantine")
        assert sorted(r["file_name"] for r in q.collect()) == ["tc_2024-01-03T00.csv.gz", "te_2024-01-04T00.csv.gz"]


def test_table_folders_layout_replaces_only_written_dates(spark, tmp_dir):
    out = f"{tmp_dir}/lake"
    a = spark.createDataFrame([("t1_session", "2024-01-01", 1), ("t1_session", "2024-01-02", 2),
                               ("t2_install", "2024-01-01", 3)], "table_name string, date string, v int")
    W.write_routed(a, out, layout="table_folders")
    assert sorted(os.listdir(out)) == ["t1_session", "t2_install"]
    b = spark.createDataFrame([("t1_session", "2024-01-02", 9)], "table_name string, date string, v int")
    W.write_routed(b, out, layout="table_folders")
    got = sorted((str(r["date"]), r["v"]) for r in spark.read.parquet(f"{out}/t1_session").collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 9)]
    assert [r["v"] for r in spark.read.parquet(f"{out}/t2_install").collect()] == [3]
    assert sorted(os.listdir(out)) == ["t1_session", "t2_install"]   # staging folder removed


def test_replayed_micro_batch_is_idempotent(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    _files(src)
    with open(f"{src}/tf_2024-01-05T00.csv.gz", "w") as f:
        f.write("adid,created_at,activity_kind\nu7,1704067200,session\nu8,1704067201,install\n")
    paths = [r["path"] for r in S.list_source_files(spark, src).collect()]
    for _ in range(2):   # the same batch id run twice, as after a failure
        INC.process_batch(spark, paths, 7, out, CLOCK, "/dlq", route=True)
    assert INC.read_ingested(spark, out).count() == 2
    assert sorted(r["table_name"] for r in spark.read.parquet(f"{out}/routed").collect()) == [
        "tf_install", "tf_session"]
    assert spark.read.parquet(f"{out}/_quarantine").count() == 2
