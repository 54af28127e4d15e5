"""Summarise the physical plans of every registered query, builds included (PLANS.md).

Each query runs alone, with an event log. All SQL executions that started while it ran count: what it returns, and the
tables, checkpoints and micro-batches that it wrote on the way. Their final (adaptive) plans are summed up: exchanges by
kind, join strategies, windows, Python nodes, scans and what reached them.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from metricmart.plans import queries as Q  # noqa: E402
from metricmart.session import build_session  # noqa: E402

COLUMNS = ["plans", "hash", "range", "single", "broadcast", "BHJ", "SMJ", "SHJ", "NL/cartesian", "window", "Python", "scan", "pushed", "partition"]


def walk(node: dict, seen: Counter) -> None:
    name, text = node["nodeName"], node["simpleString"]
    if name.startswith("Exchange"):
        seen["range" if "rangepartitioning" in text else "single" if "SinglePartition" in text else "hash"] += 1
    kinds = {"BroadcastExchange": "broadcast", "BroadcastHashJoin": "BHJ", "SortMergeJoin": "SMJ", "ShuffledHashJoin": "SHJ", "BroadcastNestedLoopJoin": "NL/cartesian",
             "CartesianProduct": "NL/cartesian", "Window": "window", "Scan parquet": "scan"}
    for start, column in kinds.items():
        seen[column] += name.split(" (")[0].strip() == start or (start == "Scan parquet" and name.startswith(start))
    seen["Python"] += any(x in name for x in ("InPandas", "InArrow", "EvalPython"))
    if name.startswith("Scan parquet"):
        seen["pushed"] += "PushedFilters: [" in text and "PushedFilters: []" not in text
        seen["partition"] += "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    for child in node["children"]:
        walk(child, seen)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    events = tempfile.mkdtemp(prefix="plans-")
    spark = build_session("local[8]", extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}", "spark.eventLog.compress": "false",
                                             "spark.eventLog.rolling.enabled": "false", "spark.sql.maxMetadataStringLength": "4000"})
    started = {}

    def run(name: str, work) -> None:
        started[name] = time.time() * 1000
        work()
        time.sleep(0.02)

    run("(load)", lambda: (Q.warehouse(spark, sf).materialize(), Q.warehouse(spark, sf, aligned=True).fct_account_transactions))
    for name, fn in Q.QUERIES.items():
        Q._RESULTS.clear()
        run(name, lambda fn=fn: fn(spark, sf).write.format("noop").mode("overwrite").save())
    spark.stop()
    begun, plans = {}, {}
    for file in os.listdir(events):
        with open(os.path.join(events, file)) as f:
            for line in f:
                if '"sparkPlanInfo"' in line:
                    e = json.loads(line)
                    plans[e["executionId"]] = e["sparkPlanInfo"]  # the last is the one that ran
                    begun.setdefault(e["executionId"], e.get("time"))
    order = sorted(started.items(), key=lambda x: x[1])
    sums = {name: Counter() for name in started}
    for number, plan in plans.items():
        owner = next((n for n, t in reversed(order) if begun[number] is not None and t <= begun[number]), None)
        if owner:
            sums[owner]["plans"] += 1
            walk(plan, sums[owner])
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` at `{sf}`. Each row sums the final adaptive plans of all that a query ran: its result, and the tables, "
          "checkpoints and micro-batches written for it (`plans`: how many). The warehouse is loaded once before (`(load)`). Single-partition exchanges "
          "carry partial aggregates (one row per task) or one row per partition. Python nodes are the alert stream's state function. Nested-loop and cartesian joins must be 0.\n")
    print("| Query | " + " | ".join(COLUMNS) + " |\n|" + "---|" * (len(COLUMNS) + 1))
    for name in started:
        print(f"| {name} | " + " | ".join(str(sums[name][c]) for c in COLUMNS) + " |")


if __name__ == "__main__":
    main()
