"""Write the physical plans of the headline queries to PLANS.md.

usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEYS = ["filter_activity", "route_events", "routing_coverage", "ad_preagg_output", "processing_stats",
        "dlq_summary", "dedupe_latest", "csv_scan"]


def tree(df) -> str:
    """The operator tree plus each scan's pushed filters and read schema."""
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    head, _, detail = text.partition("\n\n\n")
    scans = re.findall(r"\(\d+\) Scan \w+.*?\n(?:.*\n)*?(?=\n\(\d+\)|\Z)", detail)
    keep = []
    for s in scans:
        lines = [ln for ln in s.splitlines()
                 if ln.startswith("(") or ln.startswith("PushedFilters") or ln.startswith("ReadSchema")]
        keep.append("\n".join(lines))
    return head.strip() + "\n\n" + "\n".join(keep)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ebbflow.session import build_session
    from ebbflow.plans import catalog

    spark = build_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf}` (plans before AQE re-optimisation).", ""]
    for k in KEYS:
        df = catalog.QUERIES[k](spark, sf)
        out += [f"## `{k}`", "", "```", tree(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
