"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

The two hand-off stages (engineered fact, scored flights) are built first and
count ("stage_engineered", "stage_scored"); each headline query is then timed as
the median of 3 runs after one warm-up, executing the full plan through the
``noop`` sink (no collect to the driver), with no cache kept between runs.
"op_segment_zscores" runs the z-score operator itself on the engineered fact
(the query ``segment_zscores`` reads its stored result). The ML query trains
7 x 5 ridge fits, so it gets one timed run after the warm-up.
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
    "route_summary",
    "op_segment_zscores",
    "segment_zscores",
    "route_opportunity",
    "segment_opportunity",
    "anomaly_monitor",
    "corr_matrix",
    "vif",
    "ridge_cv",
]
SINGLE_RUN = {"ridge_cv"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "4")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from burnlens.plans import catalog, stages
    from burnlens.session import build_session

    spark = build_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    spark.sparkContext.setLogLevel("OFF")
    qs = catalog.all_queries()
    times: dict[str, float] = {}

    t = time.perf_counter()
    stages.engineered(spark, sf_dir)
    times["stage_engineered"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    stages.scored(spark, sf_dir)
    times["stage_scored"] = round(time.perf_counter() - t, 3)

    from burnlens.plans import catalog_more

    def zscores(spark, sf_dir):
        return stages.zscored_plan(stages.engineered(spark, sf_dir))

    qs["op_segment_zscores"] = zscores

    def run(name: str) -> float:
        catalog_more.clear_models()  # ML queries must train, not reuse
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:
        run(name)  # warm-up
        n = 1 if name in SINGLE_RUN else 3
        times[name] = round(statistics.median(run(name) for _ in range(n)), 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
