"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Every query runs once
to warm up and then three times; the median counts. Results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import pyspark

from tarmac.catalog import QUERIES
from tarmac.session import local_session

HEADLINE = [
    "kpi_route_traffic",
    "kpi_avg_duration_by_airline",
    "kpi_avg_duration_by_route",
    "kpi_airline_distribution",
    "kpi_delay_summary",
    "kpi_revenue_by_airline",
    "kpi_departure_slots",
    "kpi_booking_status",
    "kpi_payment_methods",
    "kpi_passenger_demographics",
    "kpi_frequent_flyers",
    "kpi_airline_passenger_demographics",
    "master_4way",
    "measures_by_dimension",
    "profile_table",
]
WARM_RUNS = 3


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    medians = {}
    for name in HEADLINE:
        seconds(spark, folder, name)
        medians[name] = round(statistics.median(seconds(spark, folder, name) for _ in range(WARM_RUNS)), 3)
        print(f"{name}: {medians[name]} s", file=sys.stderr, flush=True)
    result = {
        "metric": "sum of median seconds over the headline queries",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "spark": pyspark.__version__,
        "driver_memory": spark.conf.get("spark.driver.memory"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
