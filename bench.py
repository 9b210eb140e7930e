"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is fully executed through the ``noop`` sink (every row produced, nothing
collected to the driver).  The queries run four times in one JVM: the first (cold) pass includes
code generation and JIT warm-up; of the other (warm) passes the median of each query is its
steady-state cost.  ``value`` is the sum of these, the cold timings are reported alongside.
MAE and R2 are those of a small forest (BENCH_TREES, BENCH_DEPTH), outside ``value``;
BENCH_TRAIN=1 fits the full one instead.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from airshed.functions import constants as K  # noqa: E402
from airshed.ml import model as M  # noqa: E402
from airshed.plans import queries as Q  # noqa: E402
from airshed.session import get_spark  # noqa: E402

HEADLINE = ["gold_stations", "gold_traffic", "combined", "horizon_samples", "station_current",
            "overview", "ml_features", "sensor_pivot", "source_fallback", "uv_enrich",
            "weather_silver", "traffic_silver"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="airshed-bench",
                      shuffle_partitions=max(8, 2 * int(cpus)),
                      conf={"spark.driver.memory": "16g"})
    passes = []
    for _ in range(4):
        times = {}
        for name in HEADLINE:
            t0 = time.perf_counter()
            run(Q.QUERIES[name](spark, sf_dir))
            times[name] = round(time.perf_counter() - t0, 3)
        passes.append(times)
    cold, *warm = passes
    times = {name: median(p[name] for p in warm) for name in HEADLINE}
    full = os.environ.get("BENCH_TRAIN") == "1"
    trees, depth = (K.RF_TREES, M.MAX_DEPTH) if full else (int(os.environ.get("BENCH_TREES", "10")),
                                                           int(os.environ.get("BENCH_DEPTH", "8")))
    t0 = time.perf_counter()
    t = M.train(Q.QUERIES["horizon_samples"](spark, sf_dir), trees, depth)
    extra = {"mae": round(t.mae, 3), "r2": round(t.r2, 4), "n_samples": t.n_samples, "trees": trees,
             "depth": depth, "train_seconds": round(time.perf_counter() - t0, 3)}
    tag = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf = float(tag)
    except ValueError:
        sf = tag
    print(json.dumps({"metric": "total_query_seconds_warm", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "cold_total": round(sum(cold.values()), 3), "cold_queries": cold, **extra}))


if __name__ == "__main__":
    main()
