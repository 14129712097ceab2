"""Volume trial of the large-data paths (not part of the registered queries).

Derives N x the sf trips from the driver tables with Spark: every event
appears N times, replica r with its points moved by 10*r degrees, so that
distinct points and tuples grow with N. Ingests them once with default
limits and once with limits that force the large-data paths
(range-partitioned ids, no broadcast lookups, salted hot keys), and checks
that both warehouses give the same metrics.

With ``--skew``, a third of all trips share one (origin, destination,
time range) tuple and have no region, and Spark's event log (written to
the scratch folder) is read back to report, per run, the shuffle records
read by the busiest and the median task of the heaviest stage.

usage: python scripts/scale_trial.py [--skew] [SF_DIR] [N]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from triploom.operators import weekly_avg_bbox_star, weekly_avg_by_region_star  # noqa: E402
from triploom.plans.ingest import ingest  # noqa: E402
from triploom.session import local_session  # noqa: E402
from triploom.sources.fixture import point_text, trips_from_tables  # noqa: E402
from triploom.sources.warehouse import read_dims, read_table  # noqa: E402

FORCED = {"triploom.denseIds.rowsPerTask": "1",
          "triploom.dim.broadcastMaxRows": "0",
          "triploom.skew.hotKeyRows": "20000",
          "spark.sql.autoBroadcastJoinThreshold": "-1",
          "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def replicated(spark, sf_dir, n, skew=False):
    base = trips_from_tables(spark, sf_dir)
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).select("event_id", "user_id")
    t = base.join(ev, base.trip_key == ev.event_id).drop("event_id")
    t = t.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    eid, uid, rep = F.col("trip_key"), F.col("user_id"), F.col("rep")
    out = t.select(
        "region",
        point_text(uid % 4 + rep * 10, eid % 5).alias("origin_coord"),
        point_text(eid % 3 + rep * 10, uid % 5).alias("destination_coord"),
        "datetime", "datasource", eid.alias("_e"))
    if skew:
        # a third of the trips: one origin, one destination, 08:15 on their
        # own day (so one time range, weeks unchanged), and no region
        hot = F.col("_e") % 3 == 0
        at_815 = F.make_timestamp_ntz(F.year("datetime"), F.month("datetime"),
                                      F.dayofmonth("datetime"), F.lit(8), F.lit(15), F.lit(0))
        out = out.withColumns({
            "region": F.when(~hot, F.col("region")),
            "origin_coord": F.when(hot, F.lit("POINT (7.7 45.05)"))
            .otherwise(F.col("origin_coord")),
            "destination_coord": F.when(hot, F.lit("POINT (7.6 45.1)"))
            .otherwise(F.col("destination_coord")),
            "datetime": F.when(hot, at_815).otherwise(F.col("datetime"))})
    return out.drop("_e")


def busiest_stage(log_dir, after):
    """(max, median) shuffle records read per task in the stage that read
    the most shuffle records, over event-log lines after ``after``."""
    per_stage = {}
    for path in glob.glob(os.path.join(log_dir, "**"), recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as f:
            lines = f.readlines()[after.get(path, 0):]
        for line in lines:
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerTaskEnd":
                continue
            m = ev.get("Task Metrics") or {}
            rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            per_stage.setdefault(ev["Stage ID"], []).append(rec)
    if not per_stage:
        return None
    tasks = max(per_stage.values(), key=sum)
    return max(tasks), statistics.median(tasks), len(tasks)


def log_positions(log_dir):
    out = {}
    for path in glob.glob(os.path.join(log_dir, "**"), recursive=True):
        if os.path.isfile(path):
            with open(path) as f:
                out[path] = sum(1 for _ in f)
    return out


def metrics(spark, root):
    trip = read_table(spark, root, "trip")
    region = sorted(tuple(r) for r in weekly_avg_by_region_star(
        trip, read_table(spark, root, "region")).collect())
    box = weekly_avg_bbox_star(trip, read_table(spark, root, "coord_time"),
                               read_table(spark, root, "coord"), 1.0, 41.0, 32.03, 43.0
                               ).first()[0]
    return region, box


def main():
    args = sys.argv[1:]
    skew = "--skew" in args
    args = [a for a in args if a != "--skew"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    n = int(args[1]) if len(args) > 1 else 10
    work = tempfile.mkdtemp(prefix="scale-trial-")
    log_dir = os.path.join(work, "events")
    os.makedirs(log_dir)
    spark = local_session(conf={"spark.eventLog.enabled": "true",
                                "spark.eventLog.dir": "file:" + log_dir,
                                "spark.eventLog.rolling.enabled": "false",
                                "spark.eventLog.compress": "false"})
    raw = replicated(spark, sf_dir, n, skew)
    results = {}
    for label, conf in (("default", {}), ("forced", FORCED)):
        for k, v in conf.items():
            spark.conf.set(k, v)
        root = os.path.join(work, label)
        marks = log_positions(log_dir)
        t0 = time.perf_counter()
        ingest(spark, raw, root)
        took = time.perf_counter() - t0
        busy = busiest_stage(log_dir, marks)
        if busy:
            print(f"{label}: heaviest stage, shuffle records per task: max {busy[0]}, "
                  f"median {busy[1]}, tasks {busy[2]}", flush=True)
        dims = read_dims(spark, root)
        results[label] = metrics(spark, root)
        print(f"{label}: ingest {took:.1f}s, trips {read_table(spark, root, 'trip').count()}, "
              f"coords {dims.coord.rows}, coord_time {dims.coord_time.rows}", flush=True)
        for k in conf:
            spark.conf.unset(k)
    same = results["default"] == results["forced"]
    print("region/box metrics equal:", same, results["default"][1])
    spark.stop()
    sys.exit(0 if same else 1)


if __name__ == "__main__":
    main()
