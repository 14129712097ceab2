"""Live weekly trip counts per region over the trip stream.

The batch metrics are recomputed from the stored fact, so a late trip only
changes its week at the next query. This module keeps the weekly counts
current while files land: a Structured Streaming aggregation over 7-day
tumbling windows that start on Monday 00:00 (epoch day 0 was a Thursday,
hence the 4-day offset). There is no watermark: a trip counts however late
its file lands. The state is one row per (region, week) ever seen, a few
thousand rows for decades of trips, not one per trip, so no row needs to be
given up to bound it.

Results go out in ``update`` mode: each micro-batch writes the changed
(region, week) rows, each with the full running count, into a folder
``query=<id>/epoch=<n>`` of a changelog, which a replay replaces. The id is
the query's, kept in its checkpoint, so a new checkpoint starts a changelog
of its own. The current view is the latest row per group of the query that
wrote last. :func:`compact_changes` merges old epochs into runs
(:mod:`triploom.sources.runs`).

:func:`start_weekly_boxes` does the same for boxes that were registered
before: a trip adds its hits to each box that it touches, and the box metric
is the mean over the weeks of the view.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from triploom.functions import Box, week_key
from triploom.operators.clean import clean_trips
from triploom.operators.metrics import endpoint_contribution
from triploom.sources.csv_trips import stream_trips
from triploom.sources import runs as R
from triploom.sources.warehouse import path_exists

WEEK = "7 days"
MONDAY_OFFSET = "4 days"
STATE_PARTITIONS = 8
START_SECONDS = 60
CHANGES = "{key} string, week_start timestamp_ntz, num_trips long, written_at timestamp"
BOXES = "box string, x_min double, x_max double, y_min double, y_max double"
MAX_BOXES = 1000   # registered boxes are literals of the query


def _as_instant(ntz, zone: str):
    """Wall-clock TIMESTAMP_NTZ -> TIMESTAMP at the same wall clock in UTC."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz).cast("timestamp")


def _as_wall_clock(ts, zone: str):
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts.cast("timestamp_ntz"))


def weekly_counts_stream(trips: DataFrame, group_col: str = "region") -> DataFrame:
    """(region, week_start, num_trips) per Monday-to-Sunday week of a stream
    of cleaned trips; every trip counts, late ones too."""
    zone = trips.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
    return (trips.filter(F.col(group_col).isNotNull())
            .withColumn("_event_time", _as_instant(F.col("datetime"), zone))
            .groupBy(F.window("_event_time", WEEK, startTime=MONDAY_OFFSET).alias("_w"),
                     F.col(group_col))
            .agg(F.count(F.lit(1)).alias("num_trips"))
            .select(F.col(group_col).alias("region"),
                    _as_wall_clock(F.col("_w.start"), zone).alias("week_start"),
                    "num_trips"))


def register_boxes(spark: SparkSession, path: str, boxes: dict) -> DataFrame:
    """Store named boxes (any two opposite corners: x_a, y_a, x_b, y_b), at
    most ``MAX_BOXES``; returns the table."""
    if len(boxes) > MAX_BOXES:
        raise ValueError(f"at most {MAX_BOXES} boxes, not {len(boxes)}")
    rows = [(name, b.x_min, b.x_max, b.y_min, b.y_max) for name, b in (
        (n, Box.from_corners(*corners)) for n, corners in boxes.items())]
    spark.createDataFrame(rows, BOXES).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(BOXES).parquet(path)


def weekly_boxes_stream(trips: DataFrame, boxes: list[tuple[str, Box]],
                        count: str = "endpoints") -> DataFrame:
    """(box, week_start, num_trips): hits per registered box and week of a
    stream of cleaned trips. The boxes of a trip are found row by row; trips
    outside of all add no row."""
    zone = trips.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
    hits = F.array(*[F.struct(F.lit(name).alias("box"),
                              endpoint_contribution(box, count)[0].cast("long").alias("hits"))
                     for name, box in boxes])
    return (trips.withColumn("_event_time", _as_instant(F.col("datetime"), zone))
            .select("_event_time", F.explode(F.filter(hits, lambda h: h["hits"] > 0)).alias("_h"))
            .groupBy(F.window("_event_time", WEEK, startTime=MONDAY_OFFSET).alias("_w"),
                     F.col("_h.box").alias("box"))
            .agg(F.sum("_h.hits").alias("num_trips"))
            .select("box", _as_wall_clock(F.col("_w.start"), zone).alias("week_start"),
                    "num_trips"))


def start_weekly_counts(spark: SparkSession, landing: str, out: str, checkpoint: str,
                        available_now: bool = True, processing_time: str | None = None,
                        state_partitions: int = STATE_PARTITIONS) -> StreamingQuery:
    """Keep ``out`` (a changelog table) up to date from the landing folder.

    ``state_partitions`` sets the number of state-store partitions when the
    query first starts (it is then fixed by the checkpoint). The state is
    one row per (region, week), so a few partitions fit any input size.
    """
    counts = weekly_counts_stream(clean_trips(stream_trips(spark, landing)))
    return _keep(spark, counts, out, checkpoint, available_now, processing_time,
                 state_partitions)


def start_weekly_boxes(spark: SparkSession, landing: str, boxes: DataFrame, out: str,
                       checkpoint: str, count: str = "endpoints", available_now: bool = True,
                       processing_time: str | None = None,
                       state_partitions: int = STATE_PARTITIONS) -> StreamingQuery:
    """Keep the weekly hits of the registered ``boxes`` up to date in ``out``.
    The state is one row per (box, week). Another set of boxes needs another
    checkpoint, as the trips that have passed aren't read again."""
    rows = boxes.limit(MAX_BOXES + 1).collect()
    if not 0 < len(rows) <= MAX_BOXES:
        raise ValueError(f"from 1 to {MAX_BOXES} boxes can be registered")
    named = [(r["box"], Box(r["x_min"], r["x_max"], r["y_min"], r["y_max"])) for r in rows]
    counts = weekly_boxes_stream(clean_trips(stream_trips(spark, landing)), named, count)
    return _keep(spark, counts, out, checkpoint, available_now, processing_time,
                 state_partitions)


def _keep(spark: SparkSession, counts: DataFrame, out: str, checkpoint: str,
          available_now: bool, processing_time: str | None,
          state_partitions: int) -> StreamingQuery:
    """Write the changes of ``counts`` to the changelog ``out``."""
    query_id: list[str] = []
    started = threading.Event()

    def write(batch: DataFrame, epoch: int) -> None:
        if not started.wait(START_SECONDS):
            raise RuntimeError("the query's id is not known")
        (batch.withColumn("written_at", F.current_timestamp())
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(os.path.join(out, f"query={query_id[0]}", f"epoch={epoch}")))

    writer = (counts.writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    key = "spark.sql.shuffle.partitions"
    saved = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        query = writer.start()
    finally:
        spark.conf.set(key, saved)
    query_id.append(str(query.id))
    started.set()
    return query


def current_weekly_bbox(spark: SparkSession, out: str, boxes: DataFrame,
                        week: str = "week") -> DataFrame:
    """(box, weekly_avg_trips_bb): the box metric of every registered box from
    the changelog; 0.0 without hits."""
    weeks = current_weekly_counts(spark, out, "box")
    per_week = weeks.groupBy("box", *week_key("week_start", week)).agg(
        F.sum("num_trips").alias("num_trips"))
    means = per_week.groupBy("box").agg(F.avg("num_trips").alias("_mean"))
    return boxes.select("box").join(means, "box", "left").select(
        "box", F.coalesce("_mean", F.lit(0.0)).alias("weekly_avg_trips_bb"))


def current_weekly_counts(spark: SparkSession, out: str, key: str = "region") -> DataFrame:
    """The latest count of every (region, week) in the changelog; of every
    (box, week) with ``key="box"``."""
    changes = CHANGES.format(key=key)
    if not path_exists(spark, out):
        return spark.createDataFrame([], changes).drop("written_at")
    last = _last_query(spark, out)
    return (_changes(spark, out, last, key).groupBy(key, "week_start")
            .agg(F.max_by("num_trips", "epoch").alias("num_trips")))


def _last_query(spark: SparkSession, out: str) -> str | None:
    """The query (one per checkpoint) that wrote last. Its last epoch is
    never removed, so the folders alone tell."""
    log = spark.read.schema("written_at timestamp, query string, epoch long").parquet(out)
    return log.agg(F.max_by("query", "written_at")).first()[0]


def _changes(spark: SparkSession, out: str, query: str | None, key: str) -> DataFrame:
    """A query's changes by epoch, from runs as far as there are any."""
    schema = CHANGES.format(key=key) + ", query string, epoch long"
    df = spark.read.schema(schema).parquet(out).filter(F.col("query") == F.lit(query))
    merged = R.current(spark, _query_path(out, query)) if query else []
    if not merged:
        return df
    old = spark.read.schema(schema).parquet(*[r.path for r in merged])
    return old.unionByName(df.filter(F.col("epoch") > merged[-1].last))


def _query_path(out: str, query: str) -> str:
    return os.path.join(out, f"query={query}")


def compact_changes(spark: SparkSession, out: str, key: str = "region") -> int:
    """Merge the epochs of the changelog's last query, but for the last one,
    which a replay may still replace, into runs with one row per group: its
    latest count. Returns the last merged epoch (-1: none). The folders stay
    until :func:`vacuum_changes`."""
    query = _last_query(spark, out) if path_exists(spark, out) else None
    if query is None:
        return -1
    home = _query_path(out, query)
    merged = R.current(spark, home)
    changes = _changes(spark, out, query, key)
    last = changes.agg(F.max("epoch")).first()[0] - 1
    span = R.next_span(merged, last)
    if span is None:
        return merged[-1].last if merged else -1
    newest = changes.filter(F.col("epoch").between(*span)).groupBy(key, "week_start").agg(
        F.max_by(F.struct("num_trips", "written_at", "query", "epoch"), "epoch").alias("_c"))
    path = R.new_path(home, span)
    newest.select(key, "week_start", "_c.*").coalesce(1).write.parquet(path)
    R.finish(spark, path)
    return span[1]


def vacuum_changes(spark: SparkSession, out: str, older_than: float = R.KEEP_SECONDS) -> int:
    """Remove the epochs that runs have replaced ``older_than`` seconds ago."""
    query = _last_query(spark, out) if path_exists(spark, out) else None
    if query is None:
        return 0
    home = _query_path(out, query)
    return R.vacuum(spark, home, [(home, "epoch=")], older_than)
