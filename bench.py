"""Benchmark: run the headline queries on ``$BENCH_SF_DIR`` and print one JSON line.

Each query runs to Spark's ``noop`` sink (the full plan executes, nothing is
collected to the driver).  After one warm-up pass over all queries (JIT,
file listing caches), every query is timed ``$BENCH_REPEAT`` times (default
1) and the median is reported.  ``value`` is the sum of the medians.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # windows / joins / aggregates
    "win_consecutive_change",
    "win_max_change_per_key",
    "win_row_number",
    "join_type_counts_orders",
    "join_inner",
    "report_calendar_left_join",
    "agg_avg",
    "agg_collect_ordered",
    "agg_duplicate_check",
    "sort_mixed",
    "fn_round",
    # sources / sinks
    "src_csv_infer",
    "sink_formats",
    "inc_append_new_only",
    # statement text
    "txt_outline_expenses",
    "txt_position_records",
    "report_adjusted_expenses",
    # observations
    "json_observations",
    "obs_max_wind_change",
    # clustering / images
    "ml_standard_scale",
    "ml_wcss_by_label",
    "ml_kmeans",
    "img_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    from tidepool.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                          extra={"spark.driver.memory": "16g"})
    from tidepool.plans import QUERIES

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in HEADLINE:  # warm-up
        run(n)
    times = {n: round(statistics.median(run(n) for _ in range(repeat)), 3) for n in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
