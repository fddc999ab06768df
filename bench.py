"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is executed completely, into the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from logweir.plans.catalog import QUERIES
from logweir.session import local_session

HEADLINE = (
    "valid_logs", "malformed_by_reason", "throughput_windows", "error_rate_windows",
    "throughput_summary", "error_breakdown", "window_summary", "throughput_change",
    "throughput_spikes", "consumer_lag", "latest_lag", "lag_recovery", "partition_overview",
    "backpressure_states", "pause_resume_events", "paused_partitions", "dlq_log", "dlq_enriched",
    "dlq_stats", "dlq_page", "dlq_replay", "log_search", "logs_in_dlq", "log_gaps",
    "ingest_delay", "lost_messages", "document_message_checks", "document_log_search",
)


#: A smaller input of the same kind, to tell what a query costs at any size from what rows cost.
SMALLER = "sf0.01"


def run(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def table_of(name: str) -> str:
    return "documents" if name.startswith("document_") else "events"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    small_dir = os.path.join(os.path.dirname(sf_dir), SMALLER)
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores)
    spark.sparkContext.setLogLevel("OFF")

    def counts(folder: str) -> dict[str, int]:
        return {t: spark.read.parquet(f"{folder}/{t}.parquet").count() for t in {table_of(n) for n in names}}

    rows = counts(sf_dir)
    run("valid_logs", spark, sf_dir)  # start-up and first compilation are not measured
    seconds = {name: round(run(name, spark, sf_dir), 3) for name in names}
    total = round(sum(seconds.values()), 3)
    split = {}
    if small_dir != sf_dir and os.path.isdir(small_dir):
        few = counts(small_dir)
        for name in names:
            table, small = table_of(name), run(name, spark, small_dir)
            per_row = max(0.0, seconds[name] - small) / max(1, rows[table] - few[table])
            split[name] = {"fixed_sec": round(max(0.0, seconds[name] - per_row * rows[table]), 3),
                           "sec_per_million_rows": round(per_row * 1e6, 3)}
    print(json.dumps({
        "metric": "total wall-clock of the headline queries", "value": total, "unit": "sec",
        "queries": seconds, "sf": sf_dir.split("/sf")[-1], "cpus": cores, "rows": rows,
        "rows_per_sec": {n: round(rows[table_of(n)] / s) for n, s in seconds.items() if s > 0},
        "target_rows_per_sec": 2000, "cost": split,
    }))


if __name__ == "__main__":
    main()
