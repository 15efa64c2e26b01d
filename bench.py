"""Time the headline queries; print one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 5; the median of the warm runs is reported).

Each query is run to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  A first pass runs every
query once (JIT and file-listing warm-up, not counted; it also stores the entry records,
which Q2 and Q3 consume as a topic, and the promotions); then each query is
timed ``BENCH_REPEAT`` times.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from entryflow.plans import catalog  # noqa: E402
from entryflow.session import build_session  # noqa: E402

# Driver tables each headline query reads (for input rows per second).
INPUTS = {
    "t14_numbering": ["events"],
    "q2_winners": ["events"],
    "q3_flagged": ["events"],
    "q5_top_viewed": ["orders"],
    "q6_posts_by_language": ["orders"],
    "q7_days_to_answer": ["orders", "orders", "lineitem"],
    "q8_active_vs_total": ["orders", "orders", "lineitem", "customer"],
}

HEADLINE = {
    "t14_numbering": "assign_numbers",
    "q2_winners": "winners_inner",
    "q3_flagged": "flagged_entries",
    "q5_top_viewed": "top_viewed",
    "q6_posts_by_language": "posts_by_language",
    "q7_days_to_answer": "days_to_answer",
    "q8_active_vs_total": "active_vs_total",
}


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = build_session(f"local[{cpus}]", app_name="entryflow-bench",
                          shuffle_partitions=max(cpus, 8),
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE.values():  # warm-up pass
        run_once(spark, catalog.QUERIES[name], sf_dir)
    times: dict[str, float] = {}
    for label, name in HEADLINE.items():
        fn = catalog.QUERIES[name]
        times[label] = round(statistics.median(run_once(spark, fn, sf_dir)
                                               for _ in range(repeat)), 3)
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count()
            for t in {t for ts in INPUTS.values() for t in ts}}
    rate = {label: round(sum(rows[t] for t in INPUTS[label]) / sec) if sec else None
            for label, sec in times.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "input_rows_per_sec": rate,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
