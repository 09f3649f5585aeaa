"""Per-query job and stage times from a Spark event log (no UI needed).

usage: BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) BENCH_REPS=1 python bench.py
       python tools/stage_times.py <that folder>
Sums job wall time per job description (bench sets it to the query name) and
lists the slowest stages with their task counts.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def main() -> None:
    files = [p for p in glob.glob(os.path.join(sys.argv[1], "**"), recursive=True)
             if os.path.isfile(p)]
    jobs, stages = {}, {}
    for path in files:
        for line in open(path):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                jobs[e["Job ID"]] = {"desc": props.get("spark.job.description", "?"),
                                     "start": e["Submission Time"], "stages": e["Stage IDs"]}
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]]["ms"] = e["Completion Time"] - jobs[e["Job ID"]]["start"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Submission Time" in si and "Completion Time" in si:
                    stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"],
                                              si["Number of Tasks"], si["Stage Name"][:50])
    per_query = defaultdict(lambda: [0, 0])
    for j in jobs.values():
        per_query[j["desc"]][0] += j.get("ms", 0)
        per_query[j["desc"]][1] += 1
    print("query, jobs, job ms (all runs)")
    for q, (ms, n) in sorted(per_query.items(), key=lambda kv: -kv[1][0]):
        print(f"{q}, {n}, {ms}")
    print("\nslowest stages: ms, tasks, name")
    for sid, (ms, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:15]:
        print(f"{sid}: {ms}, {tasks}, {name}")


if __name__ == "__main__":
    main()
