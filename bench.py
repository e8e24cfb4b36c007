"""Headline benchmark: runs the flagship and representative queries on $BENCH_SF_DIR.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is executed to completion with the no-op sink (full computation, no driver collect).
Warm JVM: two untimed warm-up queries first.  Before every timed run the cache is cleared, so a
query never profits from data another query persisted; the value is the median of
``BENCH_REPEAT`` (default 3) runs.
"""
from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldops.catalog import load_all  # noqa: E402
from fieldops.session import build_session  # noqa: E402

HEADLINE = [
    "k11_reorder_point", "k10_walk_forward_backtest", "k06_demand_classification", "k09_forecast",
    "k05_monthly_demand", "e01_hash_group_by", "d09_effective_dated_join", "d10_rolling_range_join",
    "d11_between_events_inclusive", "f09_range_frame_4_weeks", "t01_business_minutes",
    "t02_business_days", "c14_keep_latest", "b14_first_acceptable_token", "k14_depot_stockout_reconstruction",
    "k17_consumption_source_arbitration", "k29_sla_business_days_bonus", "k40_ticket_sla", "k44_pnl_by_unit",
    "f15_running_countif_islands", "u06_customer_delivery", "q03_unique_combination",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    wanted = names.split(",") if names else [n for n in HEADLINE if n in reg]
    for w in ("e01_hash_group_by", "d01_inner_join"):  # warm-up (JIT, file listing)
        reg[w].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    out = {}
    for n in wanted:
        runs = []
        for _ in range(repeat):
            spark.catalog.clearCache()
            t0 = time.time()
            reg[n].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        out[n] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_headline_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
