"""Time the registered queries at one scale and print one JSON line.

Stored layers are built first and timed as ``build_<table>``; each query then runs once to warm up and once timed,
every result row being computed and discarded. Set BENCH_QUERIES to a comma-separated list to run only those.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from carestrata import local_session  # noqa: E402
from carestrata.plans.lakehouse import open_lakehouse  # noqa: E402
from carestrata.registry import all_queries  # noqa: E402

LAYERS = [
    *["bronze_patient", "bronze_encounter", "bronze_observation", "bronze_condition", "bronze_event"],
    *["silver_patient", "silver_encounter", "silver_observation", "silver_condition"],
    *["dim_patient", "dim_condition", "dim_date", "gold_dim_patient", "gold_dim_condition"],
    *["fact_encounter", "fact_observation"],
]
# these land raw files first, so one run is enough
ONCE = {"run_two_days", "bronze_manifest_valid", "raw_folder_census", "stream_bronze_result", "bronze_explode_pages"}
ONCE |= {"stream_bronze_complete_batches", "run_log_and_events", "lifecycle_events", "catalog_tables", "stored_views"}


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    lake = open_lakehouse(spark, sf_dir)

    times = {f"build_{name}": timed(lambda name=name: lake.table(name)) for name in LAYERS}
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue

        def once(query=query) -> None:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        if name not in ONCE:
            once()
        times[name] = timed(once)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
