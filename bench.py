"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8)
the local cores, BENCH_QUERIES a comma-separated choice of queries.  Each query runs
once to warm up and three times timed; the median of the full run into the noop sink
counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace import catalog  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "word_count",
    "longest_word",
    "average_word_length",
    "top_k_words",
    "sliding_avg_word_len",
    "running_longest_word",
    "enrich_batch",
    "user_traffic",
    "tumble_count_user",
    "split_late",
    "track_speed",
    "boxed_metrics",
    "motivation_cogroup",
    "motivation_sql",
    "defaulters_cogroup",
    "personal_loan_defaulters",
    "cogroup_two",
    "enrich_orders_static",
    "enrich_orders_refreshed",
    "tumble_profit",
    "sliding_profit",
    "session_profit",
    "global_count_discarding",
    "list_file_lines",
    "unwindowed_count",
    "stream_tumble_count_user",
    "stream_running_track_speed",
    "stream_enrich_orders_refreshed",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    result = {
        "metric": "total_seconds_of_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
