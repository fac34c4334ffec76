"""Time the headline queries and print one JSON line.

Each query is run to completion including all tables it builds on the way. One untimed run of
the flagship on the smallest data warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from rentpulse.plans.queries import all_queries
from rentpulse.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP_DIR = "/root/testdata/sf0.001"

HEADLINE = [
    "stg_availability",
    "winsorize_p95",
    "agg_percentile",
    "dim_host",
    "dim_listing",
    "fact_star",
    "latest_window",
    "fact_reviews_monthly",
    "scd2_apply",
    "mart_neighbourhood",
    "mart_host",
    "mart_city",
    "export_listings_dashboard",
    "dq_unique_combo",
    "dash_reviews_by_year",
    "dash_top_neighbourhoods",
]


def run(name: str, query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    cores = int(CPUS) if CPUS.isdigit() else os.cpu_count() or 8
    spark = local_session(CPUS, shuffle_partitions=cores, memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    if os.path.isdir(WARM_UP_DIR):
        run("mart_neighbourhood", queries["mart_neighbourhood"], spark, WARM_UP_DIR)
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds[name] = round(run(name, queries[name], spark, SF_DIR), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
