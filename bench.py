"""Benchmark of logweave's headline queries.

Runs each query end to end into Spark's ``noop`` sink (full execution, no
driver collect) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints
one JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query runs once to warm up, then ``$BENCH_RUNS`` times; the median is
reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # query log -> per-file features (the reference's main pipeline)
    "feat_interval",
    "feat_interval_prod_cus",
    "feat_interval_lineitem",
    "feat_cus_count",
    "feat_prod_cus_count_deep",
    "feat_prod_cus_nuniq",
    "feat_file_daily",
    "feat_hour",
    "feat_week",
    "feat_prod_daily",
    "tfidf_product",
    "tfidf_day",
    "uncommon_pairs",
    "overlap_filtered_log",
    "dense_series",
    "slide_windows_padd",
    "assemble_features",
    "impute_by_group",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from logweave.plans import RAW
    from logweave.session import get_session

    spark = get_session(
        "logweave-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")},
    )
    names = only or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        fn = RAW[name]

        def once():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
