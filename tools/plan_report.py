"""Summarise the executed physical plan of every registered query.

    python tools/plan_report.py [--sf-dir DIR] > PLANS.md

Each query is executed (AQE final plan), then its plan is scanned for:
shuffle exchanges, broadcast / sort-merge joins, parquet scans and whether
their filters were pushed, partial aggregations, window group limits,
cartesian products and Python UDF nodes.
"""

from __future__ import annotations

import argparse
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def summarise(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0] if "== Initial Plan ==" in plan else plan
    scans = re.findall(r"FileScan parquet [^\n]*", final)
    pushed = [s for s in scans if re.search(r"PushedFilters: \[[^\]]*(GreaterThan|LessThan|EqualTo|In\()", s)]
    return {
        "shuffles": len(re.findall(r"Exchange (hash|range|single|round)", final)) + len(re.findall(r"Exchange SinglePartition", final)),
        "reused": final.count("ReusedExchange"),
        "bhj": final.count("BroadcastHashJoin"),
        "smj": final.count("SortMergeJoin"),
        "shj": final.count("ShuffledHashJoin"),
        "scans": len(scans),
        "pushed_range": len(pushed),
        "partial_agg": len(re.findall(r"functions=\[partial_", final)),
        "wgl": final.count("WindowGroupLimit"),
        "cartesian": final.count("CartesianProduct") + final.count("BroadcastNestedLoopJoin"),
        "python": final.count("BatchEvalPython") + final.count("ArrowEvalPython") + final.count("FlatMapGroupsInPandas"),
    }


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--cpus", default="8")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from tidemart.session import build_session
    from tidemart.plans import catalog

    spark = build_session(master=f"local[{args.cpus}]", shuffle_partitions=16, driver_memory="16g", checkpoint_dir=tempfile.mkdtemp(prefix="tidemart-tool-"))
    qs = catalog.all_queries()
    names = args.names or list(qs)
    print(f"# Executed plans at `{args.sf_dir}` (AQE final plans)\n")
    print("Counts per query of the final physical plan: shuffle exchanges (reused ones"
          " separately), broadcast-hash / sort-merge / shuffled-hash joins, parquet scans,"
          " scans with a pushed range/equality filter, partial (map-side) aggregations,"
          " partial+final window group limits, cartesian or nested-loop joins, Python"
          " evaluation nodes.  Generated by `tools/plan_report.py`.\n")
    cols = ["shuffles", "reused", "bhj", "smj", "shj", "scans", "pushed_range", "partial_agg", "wgl", "cartesian", "python"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name in names:
        df = qs[name](spark, args.sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarise(_final_plan(df))
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
