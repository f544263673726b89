import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import Window

from ebbflow.config import RunClock
from ebbflow.operators import governance as V
from ebbflow.operators import quality as Q
from ebbflow.operators import reports as P

CLOCK = RunClock("2024-01-31 15:00:00")
SCHEMA = "file_name string, load_timestamp timestamp, file_hash string, record_count bigint, raw_content string"


def _manifest(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_validation_reasons(spark):
    ts = dt.datetime(2024, 1, 30, 10)
    m = _manifest(spark, [
        ("ok.csv", ts, "h", 5, "a,b\n1,2"),
        ("empty_content.csv", ts, "h", 5, ""),
        ("null_content.csv", ts, "h", 5, None),
        ("zero.csv", ts, "h", 0, "a,b"),
        ("big.csv", ts, "h", 1_000_001, "a,b"),
        ("nullcount.csv", ts, "h", None, "a,b"),
        ("negative.csv", ts, "h", -1, "a,b"),
        ("old.csv", dt.datetime(2024, 1, 20), "h", 5, "a,b"),
    ])
    v = {r["file_name"]: r for r in V.validate_files(V.stage_raw_files(m, CLOCK), CLOCK).collect()}
    assert "old.csv" not in v
    assert v["ok.csv"]["is_valid_file"] and v["ok.csv"]["processing_status"] == "READY_FOR_PROCESSING"
    assert v["empty_content.csv"]["validation_error"] == "INVALID_CONTENT"
    assert v["null_content.csv"]["validation_error"] == "INVALID_CONTENT"
    assert v["zero.csv"]["validation_error"] == "EMPTY_FILE"
    assert v["big.csv"]["validation_error"] == "FILE_TOO_LARGE"
    for k in ("nullcount.csv", "negative.csv"):
        assert v[k]["is_valid_file"] is False and v[k]["validation_error"] is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.one_of(st.none(), st.integers(-2, 1_000_002)),
                          st.sampled_from([None, "", "a", "a,b"])), min_size=1, max_size=30))
def test_good_and_bad_partition_the_input(spark, rows):
    ts = dt.datetime(2024, 1, 31, 12)
    m = _manifest(spark, [(f"f{i}.csv", ts, "h", n, c) for i, n, c in rows])
    val = V.validate_files(V.stage_raw_files(m, CLOCK), CLOCK)
    good = V.processed_files(val, CLOCK).count()
    bad = V.failed_files(val, CLOCK, "/dlq").count()
    assert good + bad == len(rows)


def test_content_checks_collect_all_errors(spark):
    m = _manifest(spark, [("a.csv", None, None, None, ""), (None, None, None, None, "x"),
                          ("b.csv", None, None, None, "a,b")])
    out = {r["file_name"]: r for r in V.content_checks(m).collect()}
    assert out["a.csv"]["errors"] == ["File content is empty",
                                      "File does not appear to be valid CSV format (no commas found)"]
    assert out[None]["errors"] == ["File does not appear to be valid CSV format (no commas found)",
                                   "File name is missing"]
    assert out["b.csv"]["is_valid"] and out["b.csv"]["warnings"] == []


def test_dedupe_latest_matches_window_brute_force(spark):
    rows = [(f"f{i % 7}.csv", dt.datetime(2024, 1, 1 + (i * 3) % 11), f"h{i}", i, "x,y") for i in range(60)]
    m = _manifest(spark, rows)
    got = sorted(tuple(r) for r in V.dedupe_latest(m).select(*m.columns).collect())
    w = Window.partitionBy("file_name").orderBy(F.col("load_timestamp").desc(), F.col("file_hash").desc())
    exp = sorted(tuple(r) for r in m.withColumn("rn", F.row_number().over(w)).where("rn = 1")
                 .drop("rn").collect())
    assert got == exp


def test_reports_and_checks(spark):
    ts = dt.datetime(2024, 1, 31, 12)
    m = _manifest(spark, [("a.csv", ts, "h", 3, "a,b"), ("a.csv", ts, "h2", 3, "a,b"),
                          ("z.csv", ts, "h", 0, "a,b")])
    val = V.validate_files(V.stage_raw_files(m, CLOCK), CLOCK)
    good, bad = V.processed_files(val, CLOCK), V.failed_files(val, CLOCK, "/dlq")
    stats = P.processing_stats(good, bad).collect()
    assert len(stats) == 1 and stats[0]["successful_files"] == 2 and stats[0]["failed_files"] == 1
    assert abs(stats[0]["success_rate"] - 66.67) < 1e-9 and stats[0]["quality_rating"] == "POOR"
    checks = {(r["check_name"], r["column_name"]): r["violations"] for r in Q.run_checks(good).collect()}
    assert checks[("unique", "file_name")] == 1 and checks[("not_null", "file_name")] == 0
    plan = P.processing_stats(good, bad)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan
    fresh = Q.freshness(good, CLOCK).first()
    assert fresh["status"] == "warn" and fresh["age_seconds"] == 3 * 3600


def test_carry_resolution_keeps_flag(spark):
    ts = dt.datetime(2024, 1, 31, 12)
    m = _manifest(spark, [("z.csv", ts, "h", 0, "a,b"), ("y.csv", ts, "h", 0, "a,b")])
    failed = V.failed_files(V.validate_files(V.stage_raw_files(m, CLOCK), CLOCK), CLOCK, "/dlq")
    prev = failed.withColumn("is_resolved", F.col("file_name") == "z.csv")
    again = {r["file_name"]: r["is_resolved"] for r in V.carry_resolution(failed, prev).collect()}
    assert again == {"z.csv": True, "y.csv": False}


def test_explicit_unknown_reason_flag(spark):
    ts = dt.datetime(2024, 1, 30, 10)
    m = _manifest(spark, [("n.csv", ts, "h", None, "a,b"), ("m.csv", ts, "h", -1, "a,b")])
    v = V.validate_files(V.stage_raw_files(m, CLOCK), CLOCK, explicit_unknown_reason=True).collect()
    assert {r["validation_error"] for r in v} == {"UNKNOWN_RECORD_COUNT"}


def test_content_size_warning_is_not_an_error(spark):
    m = _manifest(spark, [("big.csv", None, None, None, "a," + "x" * 30)])
    r = V.content_checks(m, max_size=10).first()
    assert r["is_valid"] and r["errors"] == [] and r["warnings"] == ["File size exceeds 10 bytes"]
