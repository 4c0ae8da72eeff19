"""Write PLANS.md: per driver query, the executed physical plan's shape --
shuffles, join strategies, window limits, and each Parquet scan with its
ReadSchema and pushed filters -- after running it at the given scale (AQE
final plans).

usage: python scripts/plans.py [SF_DIR] [OUT]
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from isobar.plans.queries import QUERIES  # noqa: E402
from isobar.session import get_session  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
       "Exchange SinglePartition", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
       "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "WindowGroupLimit",
       "Window ", "TakeOrderedAndProject", "Generate", "SortAggregate", "HashAggregate",
       "ObjectHashAggregate", "Subquery"]

INNER = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "WindowGroupLimit", "Exchange", "Generate", "StateStoreSave"]


def summarise(plan: str) -> tuple[dict, list[str]]:
    counts = {op.strip(): plan.count(op) for op in OPS if plan.count(op)}
    scans = []
    for line in plan.split("\n"):
        if "FileScan" not in line:
            continue
        fmt = re.search(r"FileScan (\w+)", line).group(1)
        loc = re.search(r"Location: \w+\([^)]*\)\[([^\],]*)", line)
        name = loc.group(1).rstrip("/. ").rsplit("/", 1)[-1] if loc else "?"
        pf = re.search(r"PartitionFilters: (\[[^\]]*\])", line)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        schema = re.search(r"ReadSchema: (struct<.*>)", line)
        scans.append(f"{fmt} `{name}` read `{schema.group(1)[:140] if schema else '?'}` "
                     f"pushed `{pushed.group(1)[:100] if pushed else '[]'}`"
                     + (f" partition `{pf.group(1)[:100]}`" if pf and pf.group(1) != "[]" else ""))
    return counts, scans


def executions(log_dir: str) -> list[tuple[float, str]]:
    """(start in seconds, final plan) of every SQL execution in the event log."""
    found: dict[int, list] = {}
    for d, _, names in os.walk(log_dir):
        for line in (x for n in names for x in open(os.path.join(d, n), errors="replace")):
            if "physicalPlanDescription" in line:
                e = json.loads(line)
                if "time" in e:
                    found[e["executionId"]] = [e["time"] / 1000, ""]
                if e["executionId"] in found:
                    found[e["executionId"]][1] = e["physicalPlanDescription"]
    return sorted((t, p) for t, p in found.values())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    logs = tempfile.mkdtemp(prefix="isobar-plans-")
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logs}",
                               "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    plans, began = {}, {}
    for name, fn in QUERIES.items():
        began[name] = time.time()
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        print(name, flush=True)
    ends = [*list(began.values())[1:], time.time()]
    spark.stop()
    runs = executions(logs)
    lines = [f"# Physical plans at `{sf}` (AQE final plans)", "",
             "Generated by `scripts/plans.py`. Counts are operator occurrences in the executed "
             "plan; each scan shows the columns read and the filters pushed to Parquet. For queries that "
             "write tables first, the operators of all their inner jobs are counted too.", ""]
    for name, end in zip(QUERIES, ends):
        counts, scans = summarise(plans[name])
        lines += [f"## {name}", "", ", ".join(f"{k}: {v}" for k, v in counts.items()) or "(narrow only)", ""]
        inner = [p for t, p in runs if began[name] <= t < end]
        if len(inner) > 1:
            total = sum((Counter(re.findall("|".join(map(re.escape, INNER)), p.split("\n\n")[0])) for p in inner),
                        Counter())
            lines += [f"{len(inner)} jobs in all: " + ", ".join(f"{k}: {total[k]}" for k in INNER if total[k]), ""]
        lines += [f"* {s}" for s in scans]
        lines.append("")
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
