from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbflow.functions import columns as X
from ebbflow.functions.names import clean_name, unique_clean_names


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_epoch_seconds_and_millis(spark):
    assert str(_one(spark, X.epoch_to_date("v"), "1704067200")) == "2024-01-01"
    assert str(_one(spark, X.epoch_to_date("v"), "1704067200000")) == "2024-01-01"
    # just below the threshold is still seconds
    assert _one(spark, F.year(X.epoch_to_timestamp("v")), "999999999999") > 30000


def test_tolerant_bigint(spark):
    assert _one(spark, X.tolerant_bigint("v"), "1700000000.9") == 1700000001
    assert _one(spark, X.tolerant_bigint("v"), " 42 ") == 42
    assert _one(spark, X.tolerant_bigint("v"), "bad") is None
    assert _one(spark, X.tolerant_bigint("v"), None) is None


def test_tenant_regex_greedy_and_no_match(spark):
    p = "s3://b/x/abc_2024-01-01T00_def_2024-01-02T01.csv.gz"
    assert _one(spark, X.tenant_from_path("v"), p) == "abc_2024-01-01T00_def"
    assert _one(spark, X.tenant_from_path("v"), "s3://b/nomatch.csv.gz") == ""


def test_day_boundaries_count_dates_not_24h(spark):
    df = spark.createDataFrame([("2024-01-01 23:59:00", "2024-01-02 00:01:00")], "a string, b string")
    r = df.select(X.day_boundaries(F.to_timestamp("a"), F.to_timestamp("b")).alias("d")).first()["d"]
    assert r == 1


def test_severity_boundaries(spark):
    rows = [(n,) for n in (0, 1, 2, 5, 6, 10, 11)]
    out = {r["n"]: r["s"] for r in spark.createDataFrame(rows, "n long")
           .select("n", X.severity("n").alias("s")).collect()}
    assert out == {0: "LOW", 1: "LOW", 2: "MEDIUM", 5: "MEDIUM", 6: "HIGH", 10: "HIGH", 11: "CRITICAL"}


def test_quality_rating_boundaries(spark):
    rows = [(v,) for v in (89.99, 90.0, 94.99, 95.0, 98.99, 99.0, 100.0)]
    out = {r["v"]: r["q"] for r in spark.createDataFrame(rows, "v double")
           .select("v", X.quality_rating("v").alias("q")).collect()}
    assert out == {89.99: "POOR", 90.0: "ACCEPTABLE", 94.99: "ACCEPTABLE", 95.0: "GOOD",
                   98.99: "GOOD", 99.0: "EXCELLENT", 100.0: "EXCELLENT"}


def test_success_rate_zero_denominator(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (2, 0)], "a long, b long")
    got = [r["r"] for r in df.select(X.success_rate("a", "b").alias("r")).collect()]
    assert got == [0.0, 25.0, 100.0]


def test_dlq_path_layouts(spark):
    df = spark.createDataFrame([("f.csv",)], "f string").withColumn(
        "ts", F.lit("2024-01-31 15:00:00").cast("timestamp"))
    r = df.select(*[X.dlq_path(F.lit("dlq"), "ts", "f", lay).alias(lay) for lay in ("flat", "day", "hour")]).first()
    assert (r["flat"], r["day"], r["hour"]) == ("dlq/f.csv", "dlq/2024/01/31/f.csv", "dlq/2024/01/31/15/f.csv")
    n = spark.createDataFrame([(None,)], "f string").withColumn(
        "ts", F.lit("2024-01-31 15:00:00").cast("timestamp"))
    assert n.select(X.dlq_path(F.lit("dlq"), "ts", "f", "day").alias("p")).first()["p"] == "dlq/2024/01/31/"


def test_clean_names_and_collisions():
    assert clean_name(" {Country} ") == "country"
    assert unique_clean_names(["Country", "{country}", "x"]) == ["country", "country_2", "x"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="{}Ab _c1", min_size=1, max_size=6), min_size=1, max_size=8))
def test_normalization_is_idempotent_and_unique(names):
    once = unique_clean_names(names)
    assert len(set(once)) == len(once)
    assert unique_clean_names(once) == once
