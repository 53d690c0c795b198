"""Benchmark the headline queries.

Runs every query once to warm up the JVM (JIT, class loading, plan caches),
then ``BENCH_REPEAT`` (default 5) timed runs of each query; every run executes the full plan into Spark's ``noop`` sink (no
driver collect).  Prints ONE JSON line:
{"metric": ..., "value": <sum of medians>, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterlake.operators import profiles  # noqa: E402
from meterlake.plans.catalog import QUERIES  # noqa: E402
from meterlake.session import get_session  # noqa: E402
from meterlake.sources import fixtures as fx  # noqa: E402

HEADLINE = ["hourly_load", "hourly_profile", "anomaly_3sigma", "clean_readings",
            "expected_power", "season_profile", "recent_anomalies", "impute_timestamps"]


def profile_pass(spark, sf_dir):
    """All sections of the statistics document in one scan."""
    return profiles.statistics_document(fx.readings(spark, sf_dir))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = get_session(f"local[{cpus}]", app_name="meterlake-bench",
                        shuffle_partitions=cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    runs = {name: QUERIES[name] for name in HEADLINE}
    runs["profile_pass"] = profile_pass

    def run(build) -> float:
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for build in runs.values():  # warm-up pass over every query
        run(build)
    timings = {name: round(statistics.median(run(build) for _ in range(repeat)), 4)
               for name, build in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(timings.values()), 4), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
