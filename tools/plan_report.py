"""Per-query wall time, shuffle bytes (from Spark's event log) and join strategies.

The event log goes to a fresh scratch folder; no UI, no server.
"""
from __future__ import annotations

import argparse
import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from fieldops.catalog import load_all  # noqa: E402
from fieldops.session import build_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--repeat", type=int, default=3)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    logdir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = build_session(shuffle_partitions=16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                                                              "spark.eventLog.compress": "false",
                                                              "spark.eventLog.rolling.enabled": "false"})
    reg = load_all()
    names = a.names or HEADLINE
    for w in ("e01_hash_group_by", "d01_inner_join"):
        reg[w].fn(spark, a.sf).write.format("noop").mode("overwrite").save()
    times, joins = {}, {}
    for n in names:
        df = reg[n].fn(spark, a.sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins[n] = ", ".join(f"{j}×{plan.count(j)}" for j in JOINS if plan.count(j))
        runs = []
        for i in range(a.repeat):
            spark.catalog.clearCache()
            spark.sparkContext.setJobDescription(f"{n}#{i}")
            t0 = time.time()
            reg[n].fn(spark, a.sf).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        times[n] = statistics.median(runs)
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    stage_q, shuffle = {}, {}
    for f in [x for x in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(x)]:
        with open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    m = re.match(r"(.+)#0$", desc)
                    if m:
                        for sid in ev.get("Stage IDs", []):
                            stage_q[sid] = m.group(1)
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    q = stage_q.get(ev.get("Stage ID"))
                    tm = ev.get("Task Metrics") or {}
                    b = (tm.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    if q:
                        shuffle[q] = shuffle.get(q, 0) + b
    print("| query id | sf | median s | shuffle MB | joins (initial adaptive plan) |")
    print("|---|---|---|---|---|")
    sf = re.search(r"sf([0-9.]+)", a.sf).group(1)
    for n in names:
        print(f"| {n} | {sf} | {times[n]:.2f} | {shuffle.get(n, 0) / 1e6:.1f} | {joins[n] or '–'} |")


if __name__ == "__main__":
    main()
