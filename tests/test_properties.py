"""Routing and the ad pre-aggregate against plain-Python brute force on random inputs."""
import datetime as dt
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from ebbflow.config import RunClock
from ebbflow.operators import aggregates as G
from ebbflow.operators import events as E
from ebbflow.operators import routing as R

CLOCK = RunClock("2024-02-10 00:00:00")
RULES = [
    ("session", "activity_kind", "session", None),
    ("install", "activity_kind", "install", None),
    ("ad_impression", "pp_event_name", "ad_impression", None),
    ("asset", "pp_event_name", "Asset_Balance", ["t1"]),
    ("asset_lower", "pp_event_name", "asset_balance", ["t1", "t2"]),
]
COLS = ["adid", "created_at", "installed_at", "activity_kind", "publisher_parameters", "country",
        "os_name", "device_type", "app_version_short", "filename"]

event = st.fixed_dictionaries({
    "adid": st.sampled_from(["a", "b", "c"]),
    "created": st.one_of(st.none(), st.integers(1704067200, 1707523200)),   # 2024-01-01 .. 2024-02-10
    "ms": st.booleans(),
    "age_days": st.one_of(st.none(), st.integers(0, 40)),
    "activity": st.sampled_from(["session", "install", "event", " Session ", "unknown", "install_update"]),
    "name": st.one_of(st.none(), st.sampled_from(["ad_impression", "Asset_Balance", "asset_balance", "other"])),
    "rev": st.one_of(st.none(), st.integers(0, 999)),
    "tenant": st.sampled_from(["t1", "t2", "t3", None]),
    "country": st.sampled_from(["US", None]),
})


def _row(e):
    created = None if e["created"] is None else (str(e["created"] * 1000) if e["ms"] else str(e["created"]))
    installed = None if e["created"] is None or e["age_days"] is None else str(e["created"] - e["age_days"] * 86400)
    parts = []
    if e["name"] is not None:
        parts.append(f'"adjust_event_name": "{e["name"]}"')
    if e["rev"] is not None:
        parts.append(f'"ad_revenue": "{e["rev"] / 100:.2f}"')
    params = "{" + ", ".join(parts) + "}"
    fname = f"s3://b/{e['tenant']}_2024-01-01T00.csv.gz" if e["tenant"] else "s3://b/none.csv.gz"
    return (e["adid"], created, installed, e["activity"], params, e["country"], "ios", None, "1.0", fname)


def _passes(e):
    return e["created"] is not None and e["activity"].strip().lower() in {"session", "install", "install_update", "event"}


@settings(max_examples=15, deadline=None)
@given(st.lists(event, min_size=1, max_size=40))
def test_routing_matches_brute_force(spark, events):
    raw = E.attach_tenant(spark.createDataFrame([_row(e) for e in events], ", ".join(f"`{c}` string" for c in COLS)))
    got = sorted((r["adid"], r["table_name"]) for r in R.route_events(E.process_events(raw, CLOCK), R.RuleSet(RULES)).collect())
    exp = []
    for e in events:
        if not _passes(e):
            continue
        tenant = e["tenant"] or ""
        for suffix, col, val, allowed in RULES:
            v = e["activity"] if col == "activity_kind" else e["name"]
            if v == val and (allowed is None or tenant in allowed):
                exp.append((e["adid"], f"{tenant}_{suffix.lower()}"))
    assert got == sorted(exp)


@settings(max_examples=15, deadline=None)
@given(st.lists(event, min_size=1, max_size=40))
def test_ad_preaggregate_matches_brute_force(spark, events):
    raw = E.attach_tenant(spark.createDataFrame([_row(e) for e in events], ", ".join(f"`{c}` string" for c in COLS)))
    agg = G.ad_preaggregate(E.process_events(raw, CLOCK), CLOCK).collect()
    got = {(r["prefix"], str(r["date"]), r["adid"], r["country"]): (r["ad_count"], r["ad_revenue"], r["aging"]) for r in agg}
    cutoff = dt.date(2024, 2, 10) - dt.timedelta(days=30)
    exp = defaultdict(lambda: [0, None, None])
    for e in events:
        if not _passes(e) or e["name"] != "ad_impression":
            continue
        d = dt.datetime.fromtimestamp(e["created"], dt.timezone.utc).date()
        if d < cutoff:
            continue
        k = (e["tenant"] or "", str(d), e["adid"], e["country"])
        acc = exp[k]
        acc[0] += 1
        if e["rev"] is not None:
            acc[1] = (acc[1] or 0.0) + e["rev"] / 100
        if e["age_days"] is not None:
            inst = dt.datetime.fromtimestamp(e["created"] - e["age_days"] * 86400, dt.timezone.utc).date()
            aging = (d - inst).days
            acc[2] = aging if acc[2] is None else max(acc[2], aging)
    assert set(got) == set(exp)
    for k, (n, rev, aging) in exp.items():
        gn, grev, gaging = got[k]
        assert gn == n and gaging == aging
        assert (grev is None and rev is None) or abs(grev - rev) < 1e-9
