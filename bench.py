"""Benchmark the registered batch queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced to completion with the ``noop`` sink: one warm-up run,
then the median of ``BENCH_RUNS`` (default 3) runs.  Prints one JSON line:
``{"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.registry import QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402

HEADLINE = [
    "word_count", "grep_count", "grep_lines", "avg_by_key", "sum_total_order", "group_sort", "top50_filtered",
    "left_join_year_extremes", "left_join_key_extremes", "broadcast_join", "max_by_key", "value_change",
    "moving_average", "best_window", "series_sorted", "semi_join_exact", "semi_join_bloom", "inverted_index",
    "tfidf", "english_word_count", "report_lines", "tfidf_text", "python_split_count", "mean_by_segment",
    "semi_join_unmatched", "inverted_index_lines", "first_letter_counts", "series_secondary_sort",
    "english_terms_count",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="quarry-bench", shuffle_partitions=cpus * 2,
                          conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in only:
        fn = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            once()  # warm-up
            samples = [once() for _ in range(runs)]
        except Exception as exc:  # keep measuring the others; report the failure
            errors[name] = str(exc).splitlines()[0][:200] if str(exc) else type(exc).__name__
            print(f"{name:26s} FAILED {errors[name]}", file=sys.stderr, flush=True)
            continue
        times[name] = round(statistics.median(samples), 3)
        print(f"{name:26s} {times[name]:8.3f}s  runs={[round(s, 3) for s in samples]}", file=sys.stderr,
              flush=True)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
