"""Timing of the headline queries; prints one JSON line.

``classic_build`` is the whole run on stored tables: raw, vault, point-in-time tables, marts and all
tests. The marts are then timed on the stored vault, ``delta_run`` applies batch 2, and the queries
named ``raw_*`` go from the given files to the result without storing anything.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakevault.plans import build, catalogue, marts
from lakevault.plans.queries_quality import NOW
from lakevault.plans.queries_time import AS_OF
from lakevault.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    run(catalogue.QUERIES["stage_orders"](spark, SF_DIR))  # start the JVM's code before measuring

    seconds: dict[str, list[float]] = {}

    def measure(name: str, job) -> None:
        seconds.setdefault(name, []).append(timed(job))

    def classic(lake) -> None:
        build.build_all(lake, spark, SF_DIR, AS_OF)
        build.run_tests(lake, NOW, "bench").count()

    for number in range(RUNS):
        lake = build.new_lake(spark, SF_DIR)
        measure("classic_build", lambda: classic(lake))
        tables = build.Tables(lake)
        for name, mart in marts.MARTS.items():
            measure(name, lambda: run(mart(tables)))
        measure("delta_run", lambda: build.apply_delta(lake, spark, SF_DIR, AS_OF))
        if number == 0 and RUNS > 1:
            continue  # the first round is cold; the queries below are measured from the second on
        for name in ("mart_revenue_per_customer", "pit_customer", "asof_join", "access_multi_hub",
                     "sat_user_versions", "psa_scd2_load", "stage_order_details"):
            measure(f"raw_{name}", lambda: run(catalogue.QUERIES[name](spark, SF_DIR)))

    medians = {name: round(statistics.median(values), 3) for name, values in seconds.items()}
    print(json.dumps({"metric": "total_seconds_median", "value": round(sum(medians.values()), 3), "unit": "sec",
                      "queries": medians, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                      "cpus": int(CPUS), "runs": RUNS}))


if __name__ == "__main__":
    main()
