"""Summarise the final (adaptive) physical plan of each registered query:
scanned tables with read columns and pushed filters, shuffles, join
strategies, windows and aggregates.  Writes markdown to stdout.

usage: python scripts/plan_report.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans import catalog  # noqa: E402
from strata.session import get_session  # noqa: E402


def summarise(plan: str) -> dict:
    scans = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: InMemoryFileIndex\([^)]*\)\[([^\]]*)\]"
                         r".*?PushedFilters: \[([^\]]*)\]", plan):
        table = os.path.basename(m.group(2)).replace(".parquet", "")
        cols = len([c for c in m.group(1).split(",") if c.strip()])
        scans.append((table, cols, m.group(3)))
    count = lambda pat: len(re.findall(pat, plan))
    return {
        "scans": scans,
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin"),
        "reused": count(r"ReusedExchange"),
        "smj": count(r"SortMergeJoin"), "bhj": count(r"BroadcastHashJoin"),
        "shj": count(r"ShuffledHashJoin"), "nlj": count(r"BroadcastNestedLoopJoin|CartesianProduct"),
        "windows": count(r"\bWindow \["), "hash_agg": count(r"HashAggregate\("),
        "sort_agg": count(r"SortAggregate\("), "expand": count(r"\bExpand \["),
        "skew": count(r"skew=true"),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=16)
    qs = catalog.QUERIES
    print("| query | scans (table: columns read; pushed filters) | shuffles (reused) | joins SMJ/BHJ/SHJ/NLJ | windows | hash/sort aggs | expand |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for n in names or sorted(qs):
        df = qs[n](spark, sf)
        df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()
        if "== Final Plan ==" in p:          # drop the initial adaptive plan
            p = p.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        s = summarise(p)
        scans = "; ".join(f"{t}: {c}" + (f" [{f}]" if f else "") for t, c, f in s["scans"])
        print(f"| {n} | {scans} | {s['shuffles']} ({s['reused']}) | {s['smj']}/{s['bhj']}/{s['shj']}/{s['nlj']} "
              f"| {s['windows']} | {s['hash_agg']}/{s['sort_agg']} | {s['expand']} |")


if __name__ == "__main__":
    main()
