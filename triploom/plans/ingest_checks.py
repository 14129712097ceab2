"""Registered queries that go through files and the warehouse.

The driver's raw trips are written as trip CSV files (two loads: the first
week, then the remaining days) into a fresh folder under the shared
checkpoint folder, loaded into a fresh warehouse, and every stored trip is
read back with its natural keys.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.operators.rollup import weekly_avg_bbox_rollup, weekly_avg_by_region_rollup
from triploom.plans.ingest import ingest, ingest_progress
from triploom.plans.oracle_sql import BOX, LIVE_BOXES, SECOND_LOAD_FROM
from triploom.session import scratch_path
from triploom.sources.csv_trips import list_files
from triploom.sources.fixture import trips_from_tables
from triploom.sources.warehouse import compact, read_table, vacuum
from triploom.streaming.ingest import stream_ingest
from triploom.streaming.weekly_live import (
    current_weekly_bbox, current_weekly_counts, register_boxes, start_weekly_boxes,
    start_weekly_counts,
)


def write_trip_csv(spark: SparkSession, sf_dir: str, folder: str) -> tuple[str, str]:
    """Write the raw trips as trip CSV files in two loads (first week, rest),
    with one partitioned write; return both load folders."""
    cut = F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz")
    raw = trips_from_tables(spark, sf_dir)
    (raw.select("region", "origin_coord", "destination_coord",
                F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                "datasource",
                F.when(F.col("datetime") < cut, "1").otherwise("2").alias("load"))
     .write.partitionBy("load").option("header", True).csv(folder))
    return os.path.join(folder, "load=1"), os.path.join(folder, "load=2")


def land_files(spark: SparkSession, src: str, landing: str) -> None:
    """Move the CSV files of ``src`` into ``landing`` by rename, the way
    files arrive in a landing folder (each appears whole, at once)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_path = jvm.org.apache.hadoop.fs.Path(src)
    fs = src_path.getFileSystem(conf)
    dst = jvm.org.apache.hadoop.fs.Path(landing)
    fs.mkdirs(dst)
    for status in fs.listStatus(src_path):
        name = status.getPath().getName()
        if name.endswith(".csv"):
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(
                dst, f"{os.path.basename(src.rstrip('/'))}-{name}"))


def fact_by_name(spark: SparkSession, root: str) -> DataFrame:
    """Every stored trip with the natural keys that its ids stand for. A
    phantom, missing or repeated member or trip shows in it."""
    trip, coord = read_table(spark, root, "trip"), read_table(spark, root, "coord")

    def named(name: str) -> DataFrame:
        return read_table(spark, root, name).select(
            F.col("id").alias(f"{name}_id"), F.col("description").alias(name))

    def end(side: str, key: str) -> DataFrame:
        return coord.select(F.col("id").alias(key), F.col("x").alias(f"{side}_x"),
                            F.col("y").alias(f"{side}_y"))

    pairs = (read_table(spark, root, "coord_time").withColumnRenamed("id", "coord_time_id")
             .drop("batch_id").join(end("origin", "origin_coord_id"), "origin_coord_id", "left")
             .join(end("destination", "dest_coord_id"), "dest_coord_id", "left"))
    return (trip.join(named("region"), "region_id", "left")
            .join(named("datasource"), "datasource_id", "left")
            .join(pairs, "coord_time_id", "left")
            .select("region", "datasource", "datetime", "time_range_id", "origin_x", "origin_y",
                    "destination_x", "destination_y"))


def two_loads(spark: SparkSession, sf_dir: str) -> str:
    """Both loads as batches into a fresh warehouse; returns its root."""
    work = scratch_path(spark, "batch-ingest")
    load1, load2 = write_trip_csv(spark, sf_dir, os.path.join(work, "files"))
    root = os.path.join(work, "warehouse")
    ingest(spark, load1, root)
    ingest(spark, load2, root)
    return root


def q_batch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_by_name(spark, two_loads(spark, sf_dir))


def q_compacted_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored trip after four loads (the days of a month by turns), with
    a compaction after the third and the fourth and the old folders removed."""
    work = scratch_path(spark, "compacted-ingest")
    files, root = os.path.join(work, "files"), os.path.join(work, "warehouse")
    raw = trips_from_tables(spark, sf_dir)
    (raw.select("region", "origin_coord", "destination_coord",
                F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                "datasource", (F.dayofmonth("datetime") % 4).alias("load"))
     .write.partitionBy("load").option("header", True).csv(files))
    for i in range(4):
        ingest(spark, os.path.join(files, f"load={i}"), root)
        if i >= 2:
            compact(spark, root)
            vacuum(spark, root, older_than=0)
    return fact_by_name(spark, root)


def q_weekly_avg_by_region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region metric from the weekly totals of two loads."""
    root = two_loads(spark, sf_dir)
    return weekly_avg_by_region_rollup(read_table(spark, root, "trip_weeks"),
                                       read_table(spark, root, "region"))


def q_weekly_avg_bbox_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box metric from the weekly totals of two loads."""
    root = two_loads(spark, sf_dir)
    return weekly_avg_bbox_rollup(
        read_table(spark, root, "trip_weeks"), read_table(spark, root, "coord_time"),
        read_table(spark, root, "coord"), *BOX)


def _run(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _stream_twice(spark: SparkSession, sf_dir: str) -> str:
    """Land load 1, run the stream; land load 2, run it again; run it a third
    time with nothing new. Returns the warehouse root."""
    work = scratch_path(spark, "stream-ingest")
    load1, load2 = write_trip_csv(spark, sf_dir, os.path.join(work, "files"))
    landing = os.path.join(work, "landing")
    root = os.path.join(work, "warehouse")
    ckpt = os.path.join(work, "checkpoint")
    for load in (load1, load2, None):
        if load is not None:
            land_files(spark, load, landing)
        _run(stream_ingest(spark, landing, root, ckpt))
    return root


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_by_name(spark, _stream_twice(spark, sf_dir))


def q_ingest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of two stream loads, per batch: file names depend on the run."""
    log = ingest_progress(spark, _stream_twice(spark, sf_dir))
    return log.groupBy("batch_id").agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_rejected").alias("rows_rejected"),
        F.max("new_regions").alias("new_regions"),
        F.max("new_datasources").alias("new_datasources"),
        F.max("new_coords").alias("new_coords"),
        F.max("new_coord_times").alias("new_coord_times"),
        F.max("percent").alias("percent"))


def q_quarantine_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of which a fixed share is broken, through the stream in
    quarantine mode: accepted trips per data source, rejects per reason."""
    work = scratch_path(spark, "quarantine-ingest")
    landing, root = os.path.join(work, "landing"), os.path.join(work, "warehouse")
    raw = trips_from_tables(spark, sf_dir)
    key, text = F.col("trip_key"), F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    line = F.concat_ws(
        ",", F.coalesce("region", F.lit("")),
        quoted(F.when(key % 50 == 1, F.lit("POINT (x y)")).otherwise(F.col("origin_coord"))),
        F.when(key % 50 == 2, F.lit("")).otherwise(quoted(F.col("destination_coord"))),
        F.when(key % 50 == 3, F.lit("")).when(key % 50 == 4, F.lit("2024-13-45 99:00:00"))
        .otherwise(text), F.col("datasource"))
    # a line that ends after two fields
    line = F.when(key % 50 == 5, F.concat(F.lit("Nowhere,"), quoted(F.lit("POINT (1 2)")))) \
        .otherwise(line)
    # written as they are: one column whose name is the header line
    (raw.select(line.alias("region,origin_coord,destination_coord,datetime,datasource"))
     .write.option("header", True).option("sep", "\u0001").option("quote", "")
     .option("escape", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(os.path.join(work, "files")))
    land_files(spark, os.path.join(work, "files"), landing)
    _run(stream_ingest(spark, landing, root, os.path.join(work, "checkpoint"),
                       on_error="quarantine"))
    trips = read_table(spark, root, "trip").join(
        read_table(spark, root, "datasource").select(
            F.col("id").alias("datasource_id"), "description"), "datasource_id", "left")
    accepted = trips.groupBy(F.col("description").alias("name")).agg(
        F.count(F.lit(1)).alias("num_rows")).select(F.lit("accepted").alias("kind"), "name",
                                                    "num_rows")
    malformed = F.col("reject_reason").startswith("malformed line")
    rejects = read_table(spark, root, "rejects").groupBy(F.when(
        malformed, "malformed line").otherwise(F.col("reject_reason")).alias("name")).agg(
        F.count(F.lit(1)).alias("num_rows")).select(F.lit("rejected").alias("kind"), "name",
                                                    "num_rows")
    return accepted.unionByName(rejects)


def q_stream_weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live weekly counts: land load 2, run; land load 1, run; read the view."""
    work = scratch_path(spark, "stream-weekly")
    load1, load2 = write_trip_csv(spark, sf_dir, os.path.join(work, "files"))
    landing = os.path.join(work, "landing")
    out, ckpt = os.path.join(work, "weekly"), os.path.join(work, "checkpoint")
    # the later weeks land first: late trips count like any other
    for load in (load2, load1):
        land_files(spark, load, landing)
        _run(start_weekly_counts(spark, landing, out, ckpt))
    return current_weekly_counts(spark, out)


def q_stream_weekly_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live box metric of registered boxes: load 2 lands before load 1."""
    work = scratch_path(spark, "stream-boxes")
    load1, load2 = write_trip_csv(spark, sf_dir, os.path.join(work, "files"))
    landing = os.path.join(work, "landing")
    out, ckpt = os.path.join(work, "weekly"), os.path.join(work, "checkpoint")
    boxes = register_boxes(spark, os.path.join(work, "boxes"), LIVE_BOXES)
    for load in (load2, load1):
        land_files(spark, load, landing)
        _run(start_weekly_boxes(spark, landing, boxes, out, ckpt))
    return current_weekly_bbox(spark, out, boxes)


def q_stream_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both loads through a stream that deletes what it has committed: the
    trips of each batch, and the files left in the landing folder."""
    work = scratch_path(spark, "stream-delete")
    landing, root = os.path.join(work, "landing"), os.path.join(work, "warehouse")
    for load in write_trip_csv(spark, sf_dir, os.path.join(work, "files")):
        land_files(spark, load, landing)
        _run(stream_ingest(spark, landing, root, os.path.join(work, "checkpoint"),
                           clean_source="delete"))
    trips = read_table(spark, root, "trip").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("num_trips"))
    left = list_files(spark, landing).count()   # of the files, which are gone
    return trips.withColumn("files_left", F.lit(left).cast("long"))
