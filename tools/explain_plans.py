"""Print the physical plan of registered queries, with a one-line summary per query.

Usage: python tools/explain_plans.py [sf_dir] [name ...]
The summary counts shuffles (Exchange), broadcasts, sorts and windows and lists
each scan's read schema, so a review can check that filters reach the parquet
scan, that only needed columns are read and which joins broadcast.
Set EXPLAIN_FULL=1 to also print the formatted plans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from tabula.catalog import QUERIES
    from tabula.session import get_spark

    spark = get_spark()
    for name in names or sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(k, plan)) for k in ["Exchange", "BroadcastExchange", "Sort ", "Window", "Scan"]}
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<\S*)", plan)))
        pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", plan)))
        print(f"{name}: " + ", ".join(f"{k.strip()}={v}" for k, v in counts.items()))
        for s in schemas:
            print(f"    read {s}")
        for p in pushed:
            if p != "[]":
                print(f"    pushed {p}")
        if os.environ.get("EXPLAIN_FULL"):
            df.explain("formatted")


if __name__ == "__main__":
    main()
