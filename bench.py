"""Seconds per headline query, one JSON line on stdout.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. Each query runs once to
warm up and then BENCH_RUNS times (3); the median counts. All result columns
are computed, nothing is collected. BENCH_QUERIES picks queries by name, or
"all".
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "canonical_events schema_violations malformed_split decode_records dlq_replay_counts dedup_events"
    " batch_session_facts batch_sessions session_links sessionized_events event_gaps session_event_paths"
    " session_window_sessions speed_sessions cart_totals_with_removals restatement_audit session_deltas"
    " restatement_breakdown top_restated restatement_detail late_event_match accuracy_comparison"
    " late_rate_by_hour throughput_by_window lag_by_minute lag_alarm raw_events_scan session_boundaries session_id_chunks"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from suite.queries import QUERIES
    from tidemark.session import spark_session

    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    if chosen == ["all"]:
        chosen = list(QUERIES)
    spark = spark_session("bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        times = []
        for i in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i or runs == 0:
                times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "events": events, "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
