"""Headline queries, warm, median of three; prints one JSON line.

Each query is executed in full through a sink that discards rows, so nothing is left unread and
nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakerecon import local_session  # noqa: E402
from workloads import registered  # noqa: E402

HEADLINES = [
    "latest_event_per_user",
    "latest_line_per_order",
    "recon_summary_lines",
    "line_differences",
    "missing_lines",
    "recon_summary",
    "missing_records",
    "column_diff",
    "count_recon_composite",
    "dq_failures",
    "dq_summary",
    "landing_stats_total",
    "compaction_plan_rows",
    "compact_incremental",
    "compact_lines",
    "compact_full",
    "unbox_payload",
    "quarantine_split",
    "ingest_increments",
    "load_history",
    "redact_text",
    "stream_ingest",
    "stream_stats",
]
RUNS = 3


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session("bench", cpus, **{"spark.sql.shuffle.partitions": str(cpus)})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
