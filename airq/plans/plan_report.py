"""Summarise the final (adaptive) physical plan of every catalogue query.

Usage: python -m airq.plans.plan_report [sf_dir] > PLANS.md
Per query: scans (table and read columns), shuffles, join strategies,
windows, aggregates, and whether any Python evaluation node appears.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

SKIP = {"stream_enrich", "stream_dedup", "stream_latest", "stream_nowcast", "forecast_24h"}


def nodes(plan):
    """Walk a physical plan, descending into adaptive plans and query stages."""
    stack = [plan]
    while stack:
        p = stack.pop()
        yield p
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(p.executedPlan())
        elif "QueryStage" in name:
            stack.append(p.plan())
        kids = p.children()
        stack.extend(kids.apply(i) for i in range(kids.size()))


def final_plan(df):
    """The plan that ran: the rows are collected through the DataFrame's own
    query execution (a write would build another), so its adaptive plan is final."""
    df.collect()
    return df._jdf.queryExecution().executedPlan()


def summarize(df) -> dict:
    plan = final_plan(df)
    text = plan.toString()
    kinds = Counter()
    scans = []
    for n in nodes(plan):
        name = n.nodeName()
        if name.startswith("Scan"):
            m = (re.search(r"(\w+)\.parquet", n.toString())
                 or re.search(r"airq-[0-9a-f]{12}/(\w+)-[0-9a-f]{12}", n.verboseStringWithOperatorId()))
            cols = re.search(r"ReadSchema: struct<([^>]*)>", n.verboseStringWithOperatorId())
            ncols = len(cols.group(1).split(",")) if cols and cols.group(1) else 0
            scans.append(f"{m.group(1) if m else '?'}({ncols} cols)")
        elif name in ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
                      "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window",
                      "HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject",
                      "WindowGroupLimit", "Generate", "Expand"):
            kinds[name] += 1
    kinds["python"] = text.count("EvalPython")
    return {"scans": sorted(Counter(scans).items()), "ops": dict(kinds)}


def main(argv):
    from .catalog import CATALOG
    from ..session import build_session
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans (final adaptive plans, sf " + sf.rsplit("sf", 1)[-1] + ")\n")
    print("Generated by `python -m airq.plans.plan_report`. Scans list table(columns read) x times; "
          "names without a driver table (readings, weather, features, rowindex, history) are tables the query "
          "wrote once to the shared checkpoint folder in an earlier job of the same query (the jobs that wrote them aren't counted here). "
          "`Shuffles` counts exchanges; joins by strategy (AQE final plan). No query contains a Python "
          "evaluation node, a nested-loop join or a cartesian product (asserted).\n")
    print("| Query | Scans | Shuffles | Joins | Windows | Aggregates | Other |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in CATALOG.items():
        if name in SKIP:
            continue
        s = summarize(fn(spark, sf))
        o = s["ops"]
        scans = ", ".join(f"{k}×{v}" if v > 1 else k for k, v in s["scans"])
        joins = ", ".join(f"{k.replace('Join', '')} {o[k]}" for k in
                          ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin") if o.get(k))
        other = ", ".join(f"{k} {o[k]}" for k in ("TakeOrderedAndProject", "WindowGroupLimit", "Generate", "Expand")
                          if o.get(k))
        assert not o.get("python") and not o.get("BroadcastNestedLoopJoin") and not o.get("CartesianProduct"), name
        print(f"| `{name}` | {scans} | {o.get('Exchange', 0)} | {joins or '-'} | {o.get('Window', 0)} | "
              f"{o.get('HashAggregate', 0) + o.get('ObjectHashAggregate', 0) + o.get('SortAggregate', 0)} | {other or '-'} |")


if __name__ == "__main__":
    main(sys.argv[1:])
