"""Summarise the physical plan of registered queries (after AQE finalises it).

Usage: python scripts/show_plans.py [SF_DIR] [--markdown] [name ...]

For each query: shuffles (hash exchanges and their keys), join strategies,
partial top-1 limits, broadcast exchanges, parquet scans with their read
columns and pushed filters.  The query is executed once (noop sink) so the
adaptive plan is final.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from layerworks.plans.queries import QUERIES  # noqa: E402
from layerworks.session import local_session  # noqa: E402


def summary(plan: str) -> dict[str, list[str]]:
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    keys = [re.sub(r"#\d+L?", "", e).rsplit(",", 1)[0] for e in exchanges]
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi|FullOuter|Cross)", plan)
    scans = []
    for m in re.finditer(r"Scan parquet[^\n]*", plan):
        line = m.group(0)
        schema = re.search(r"ReadSchema: struct<([^>]*)>", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        table = re.search(r"/([^/\]]+)\.parquet\]", line)
        cols = [c.split(":")[0] for c in schema.group(1).split(",")] if schema and schema.group(1) else []
        label = f"`{table.group(1) if table else '?'}` reads " + (", ".join(cols) if cols else "no columns (row count only)")
        scans.append(label + (f"; pushed: {pushed.group(1)}" if pushed and pushed.group(1) else ""))
    return {
        "shuffles": keys,
        "joins": [f"{a} {b}" for a, b in joins],
        "partial top-1": ["yes"] if "WindowGroupLimit" in plan and "Partial" in plan else [],
        "broadcasts": [str(len(re.findall(r"BroadcastExchange", plan)))],
        "scans": sorted(set(scans)),
    }


def main() -> int:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    markdown = "--markdown" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session()
    # print whole scan metadata (read schema, pushed filters) instead of abbreviations
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        if markdown:
            print(f"### {name}\n")
            print(f"- shuffles ({len(s['shuffles'])}): " + ("; ".join(f"`{k}`" for k in s["shuffles"]) or "none"))
            print(f"- joins: {', '.join(s['joins']) or 'none'}; broadcast exchanges: {s['broadcasts'][0]}")
            print(f"- partial top-1 before shuffle: {'yes' if s['partial top-1'] else 'no'}")
            for scan in s["scans"]:
                print(f"- scan: {scan}")
            print()
        else:
            print(name, s)
    return 0


if __name__ == "__main__":
    sys.exit(main())
