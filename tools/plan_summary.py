"""Summarise the physical plan of every registered query (after running it,
so adaptive decisions are final): shuffles, joins, windows, aggregates and
the columns each scan reads.  Prints a Markdown table.

    python tools/plan_summary.py [sf_dir] [query ...]

Streaming queries show the plan that reads their result back.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])


def summarize(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "reused": plan.count("ReusedExchange"),
        "broadcast joins": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "windows": plan.count("Window ["),
        "aggregates": len(re.findall(r"(HashAggregate|ObjectHashAggregate|SortAggregate)\(", plan)),
        "scans (columns read)": ", ".join(str(len(s.split(","))) for s in scans),
    }


def main() -> None:
    from playstream import get_session
    from playstream.plans.catalog import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    rows = []
    for name in sys.argv[2:] or QUERIES:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        rows.append((name, summarize(df._jdf.queryExecution().executedPlan().toString())))
    cols = list(rows[0][1])
    print("| query | " + " | ".join(cols) + " |")
    print("| --- " * (len(cols) + 1) + "|")
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
