"""Benchmark: run every registered query over the whole tables at $BENCH_SF_DIR.

Each query is fully materialised with the ``noop`` sink (all columns, all
rows, no driver collect). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlens.registry import QUERIES, ensure_landing  # noqa: E402
from marketlens.session import build_session  # noqa: E402
from marketlens.sources.adapter import RAW_ENTITIES  # noqa: E402

HEADLINE = "rpt_daily_kpis"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)
    extra = {"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # stage/task timings for offline reading
    if event_dir:
        os.makedirs(event_dir, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{cpus}]", app="marketlens-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra=extra)
    t0 = time.time()
    for entity in RAW_ENTITIES:  # one-time landing write of the hourly files (not a query)
        ensure_landing(spark, sf_dir, entity)
    landing_sec = time.time() - t0
    # warm-up: JIT and metadata caches (one query per family of plans)
    for name in (HEADLINE, "fact_order_items", "check_unique", "landing_scan"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only:
        runs = []
        for _ in range(repeat):
            t = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec_all_queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "headline": {HEADLINE: times.get(HEADLINE)}, "landing_write_sec": round(landing_sec, 3),
        "cpus": cpus, "repeat": repeat, "n_queries": len(times),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
