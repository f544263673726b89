from pyspark.sql import functions as F

from ebbflow.config import RunClock
from ebbflow.operators import aggregates as G
from ebbflow.operators import events as E
from ebbflow.operators import routing as R
from ebbflow.plans import catalog

SF = "/root/testdata/sf0.001"
CLOCK = RunClock("2024-02-10 00:00:00")


def _raw(spark, rows):
    cols = ["adid", "created_at", "installed_at", "activity_kind", "publisher_parameters", "country",
            "os_name", "device_type", "app_version_short", "filename"]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    return E.attach_tenant(df)


def test_filter_and_json(spark):
    raw = _raw(spark, [
        ("u1", "1704067200", "1703980800", " Session ", '{"adjust_event_name": "ad_impression", "ad_revenue": "1.50"}',
         "US", "ios", "phone", "1.0", "s3://b/t1_2024-01-01T00.csv.gz"),
        ("u2", None, None, "session", "{}", None, None, None, None, "s3://b/t1_2024-01-01T00.csv.gz"),
        ("u3", "1704067200000", None, "click", "not json", None, None, None, None, "s3://b/t1_2024-01-01T00.csv.gz"),
        ("u4", "bad", None, "event", "not json", None, None, None, None, "s3://b/nomatch.csv.gz"),
    ])
    p = E.process_events(raw, CLOCK).collect()
    assert sorted(r["adid"] for r in p) == ["u1", "u4"]
    u1 = [r for r in p if r["adid"] == "u1"][0]
    assert u1["pp_event_name"] == "ad_impression" and u1["pp_ad_revenue"] == "1.50"
    assert str(u1["date"]) == "2024-01-01" and u1["prefix"] == "t1"
    u4 = [r for r in p if r["adid"] == "u4"][0]
    assert u4["date"] is None and u4["pp_event_name"] is None and u4["prefix"] == ""


def test_routing_exact_case_and_allow_list(spark):
    rules = R.RuleSet([
        ("session", "activity_kind", "session", None),
        ("asset", "pp_event_name", "Asset_Balance", ["t1"]),
        ("asset_lower", "pp_event_name", "asset_balance", None),
    ])
    raw = _raw(spark, [
        ("u1", "1704067200", None, "session", '{"adjust_event_name": "Asset_Balance"}', None, None, None, None,
         "s3://b/t1_2024-01-01T00.csv.gz"),
        ("u2", "1704067200", None, "session", '{"adjust_event_name": "Asset_Balance"}', None, None, None, None,
         "s3://b/t2_2024-01-01T00.csv.gz"),
        ("u3", "1704067200", None, " Session ", '{"adjust_event_name": "asset_balance"}', None, None, None, None,
         "s3://b/t2_2024-01-01T00.csv.gz"),
    ])
    p = E.process_events(raw, CLOCK)
    got = sorted((r["adid"], r["table_name"]) for r in R.route_events(p, rules).collect())
    assert got == [("u1", "t1_asset"), ("u1", "t1_session"), ("u2", "t2_session"), ("u3", "t2_asset_lower")]
    cov = {(r["prefix"], r["suffix"]): r["routed_rows"] for r in R.routing_coverage(p, rules).collect()}
    assert ("t2", "asset") not in cov          # not permitted for t2
    assert cov[("t1", "asset_lower")] == 0     # permitted, empty
    assert sum(cov.values()) == 4              # coverage sums to the routed total


def test_routing_plan_is_one_broadcast_join_without_cartesian(spark):
    p = catalog.processed_events(spark, SF)
    plan = R.route_events(p)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    cov_plan = R.routing_coverage(p)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in cov_plan and "NestedLoop" not in cov_plan


def test_scan_prunes_columns_for_aggregate(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    plan = events.select("event_id").where(F.col("event_id") > 5)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,5)]" in plan


def test_ad_preagg_partial_aggregation_and_lookback(spark):
    p = catalog.processed_events(spark, SF)
    agg = G.ad_preaggregate(p, CLOCK)
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2  # partial + final around one exchange
    dates = [r["date"] for r in agg.select("date").distinct().collect()]
    assert min(d for d in dates if d is not None).isoformat() >= "2024-01-11"


def test_schema_contract_reports_missing_columns(spark):
    raw = catalog.raw_events(spark, SF)
    rows = {r["column_name"]: r for r in E.schema_contract(raw).collect()}
    assert len(rows) == 48
    assert rows["created_at"]["is_present"] and rows["created_at"]["cast_failures"] >= 0
    assert rows["idfa"]["is_present"] is False and rows["idfa"]["null_count"] is None


def test_routing_flags(spark):
    rules = R.RuleSet([("session", "activity_kind", "session", None)])
    raw = _raw(spark, [
        ("u1", "1704067200", None, " Session ", "{}", None, None, None, None, "s3://b/t1_2024-01-01T00.csv.gz"),
        ("u2", "1704067200", None, "session", "{}", None, None, None, None, "s3://b/nomatch.csv.gz"),
    ])
    p = E.process_events(raw, CLOCK)
    exact = sorted(r["table_name"] for r in R.route_events(p, rules).collect())
    assert exact == ["_session"]                       # parity: '' tenant routed, ' Session ' not
    norm = sorted(r["table_name"] for r in R.route_events(p, rules, normalize_activity=True,
                                                          route_empty_tenant=False).collect())
    assert norm == ["t1_session"]


def test_coverage_counts_match_routed_rows(spark):
    p = catalog.processed_events(spark, SF)
    exp = {r["table_name"]: r["count"] for r in R.route_events(p).groupBy("table_name").count().collect()}
    cov = R.routing_coverage(p)
    got = {r["table_name"]: r["routed_rows"] for r in cov.where("status = 'written'").collect()}
    assert got == exp
    assert cov._jdf.queryExecution().optimizedPlan().toString().count("] parquet") == 1  # one scan of the events


def test_unrouted_rows(spark):
    rules = R.RuleSet([("session", "activity_kind", "session", None)])
    raw = _raw(spark, [
        ("u1", "1704067200", None, "session", "{}", None, None, None, None, "s3://b/t1_2024-01-01T00.csv.gz"),
        ("u2", "1704067200", None, "install_update", "{}", None, None, None, None, "s3://b/t1_2024-01-01T00.csv.gz"),
        ("u3", "1704067200", None, "event", "{}", None, None, None, None, "s3://b/t1_2024-01-01T00.csv.gz"),
    ])
    p = E.process_events(raw, CLOCK)
    assert R.unrouted_rows(p, rules).first()["rows_unrouted"] == 2
