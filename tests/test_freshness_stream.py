"""Freshness alerts by timers: any number of runs gives the alerts of the rule over the whole table."""
import datetime as dt
import random

from ebbflow.streaming import freshness as FR


def plain(rows):
    known = max(ms for _, ms in rows) - 1
    out = []
    for source in {s for s, _ in rows}:
        times = sorted({ms for s, ms in rows if s == source})
        for a, b in zip(times, [*times[1:], known]):
            out += [(source, a, status) for status, limit in FR.LIMITS if b - a > limit]
    return sorted(out)


def test_replay_equals_the_rule(spark, tmp_dir):
    rng = random.Random(6)
    base = 1704067200000
    rows = [("a", base), ("b", base + 1000), ("c", base)]
    for source, mean in (("a", 30), ("b", 150), ("d", 400)):
        at = base
        while at < base + 3 * 86_400_000:
            at += int(rng.expovariate(1 / (mean * 60_000)))
            rows.append((source, at))
    rows += [("b", rows[-1][1]), ("a", base + 5 * 86_400_000)]  # a repeat; the last load leaves the others behind
    rows.sort(key=lambda r: r[1])
    parts = [rows[:1], rows[1:200], rows[200:201], rows[201:-1], rows[-1:]]
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    for n, part in enumerate(parts):
        stamped = [(s, dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc)) for s, ms in part]
        spark.createDataFrame(stamped, "source string, load_timestamp timestamp").coalesce(1).write.mode("append").parquet(src)
        FR.run_alerts(spark, spark.readStream.schema("source string, load_timestamp timestamp").parquet(src), out, ck)
        if n in (1, 4):
            got = sorted(map(tuple, spark.read.schema(FR.ALERT_DDL).parquet(out).collect()))
            assert got == plain([r for p in parts[:n + 1] for r in p])
    assert any(s == "error" for _, _, s in got) and ("c", base, "error") in got
