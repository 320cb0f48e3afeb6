"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS warm runs
per query (default 3, the median counts), BENCH_ALL=1 for every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from opsframe.plans import registry
from opsframe.session import build_session

HEADLINE = [
    "index_query", "failed_runs", "topk_per_pipeline", "batch_get", "run_stats", "run_report",
    "overview", "lineage_usage", "dedup_latest", "insert_if_absent", "partial_update", "upsert",
    "upsert_many", "conditional_update", "activate_all", "run_status_update", "stage_upsert",
    "fold_events", "rejected_rows", "dq_results", "pk_duplicates",
    "conditional_put", "stage_append", "metrics_merge", "record_outputs", "apply_folds", "cancel_running",
    "failed_runs_by_day", "config_write", "job_run", "run_log_by_day", "fold_events_stream",
]

# The table whose rows a query is measured in.
DRIVING = {
    "index_query": "events", "run_stats": "events", "fold_events": "events",
    "upsert_many": "lineitem", "dedup_latest": "lineitem", "dq_results": "lineitem",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    names = list(queries) if os.environ.get("BENCH_ALL") else HEADLINE

    def once(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once("full_scan")
    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    counts = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(DRIVING.values())}
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total" if names is HEADLINE else "all_queries_total",
        "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
        "rows_per_sec": {n: round(counts[t] / seconds[n]) for n, t in DRIVING.items() if n in seconds},
        "cores": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
