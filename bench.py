"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver). Before timing, every query
runs once on the smallest scale factor (not timed), so the numbers are
steady-state JVM timings rather than class loading and JIT warm-up; each
query is then timed twice and the faster run is reported, which damps
noise from other load on the machine. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from triploom.operators import (  # noqa: E402
    weekly_avg_bbox_star, weekly_avg_by_region_star,
)
from triploom.plans import catalog  # noqa: E402
from triploom.plans.ingest_checks import two_loads  # noqa: E402
from triploom.plans.oracle_sql import BOX  # noqa: E402
from triploom.session import local_session  # noqa: E402
from triploom.sources.warehouse import read_table  # noqa: E402

HEADLINE = [
    "clean_trips",
    "weekly_avg_by_region",
    "weekly_avg_by_region_iso_year",
    "weekly_avg_bbox",
    "weekly_avg_bbox_trips",
    "coord_time_dim",
    "trip_fact",
    "weekly_avg_by_region_star",
    "weekly_avg_bbox_star",
    "batch_ingest",
    "stream_ingest",
]


# The star metrics as users run them: over a warehouse that is there already.
STORED = {
    "stored_weekly_avg_by_region": lambda spark, root: weekly_avg_by_region_star(
        read_table(spark, root, "trip"), read_table(spark, root, "region")),
    "stored_weekly_avg_bbox": lambda spark, root: weekly_avg_bbox_star(
        read_table(spark, root, "trip"), read_table(spark, root, "coord_time"),
        read_table(spark, root, "coord"), *BOX),
}


def timed(query, spark, where: str, times: int = 2) -> float:
    runs = []
    for _ in range(times):
        t0 = time.perf_counter()
        query(spark, where).write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t0)
    return round(min(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="triploom-bench")
    qs = catalog.queries()
    warm_dir = os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:  # warm-up, not timed
        qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {name: timed(qs[name], spark, sf_dir) for name in names}
    if names == HEADLINE:
        root = two_loads(spark, sf_dir)
        times |= {name: timed(q, spark, root, times=3) for name, q in STORED.items()}
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
