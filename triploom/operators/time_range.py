"""Half-hour time ranges: the seeded dimension, assignment and range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.functions import time_of_day, time_range_label
from triploom.operators.dims import broadcast_max_rows

# Fixed values of the seeded table: 48 ranges of 30 minutes over one day,
# ids 1..48, bounds as HHMM integers, label "HHMM-HHMM".
RANGES_PER_DAY = 48
RANGE_MINUTES = 30


def time_range_dim(spark: SparkSession) -> DataFrame:
    """(id, range, time_from, time_to): '0000-0029' (id 1) .. '2330-2359' (id 48).

    Built from a rule, not a list: range i starts at minute 30*i of the day.
    """
    i = F.col("id")
    start_minute = i * RANGE_MINUTES
    time_from = ((start_minute / 60).cast("int") * 100 + start_minute % 60).cast("int")
    return (spark.range(RANGES_PER_DAY)
            .select((i + 1).cast("int").alias("id"), time_from.alias("time_from"))
            .withColumn("time_to", (F.col("time_from") + RANGE_MINUTES - 1).cast("int"))
            .select("id", time_range_label("time_from", "time_to").alias("range"),
                    "time_from", "time_to"))


def time_range_assign(trips: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """(id, range, time_from, time_to, num_trips): trips per seeded range.

    Trips carry ``time_range_id`` from arithmetic (no join per trip); the
    counts are aggregated map-side and the 48-row table is joined to the
    48 aggregated rows.
    """
    ranges = ranges if ranges is not None else time_range_dim(trips.sparkSession)
    counts = (trips.groupBy(F.col("time_range_id").alias("id"))
              .agg(F.count(F.lit(1)).alias("num_trips")))
    return (ranges.join(counts, "id", "left")
            .select("id", "range", "time_from", "time_to",
                    F.coalesce("num_trips", F.lit(0)).cast("long").alias("num_trips")))


def range_bucket_join(df: DataFrame, value, ranges: DataFrame, lo: str = "time_from",
                      hi: str = "time_to", id_col: str = "id",
                      bucket_width: int = 100, how: str = "inner",
                      bucket_rows: int | None = None,
                      out_col: str | None = None) -> DataFrame:
    """Attach ``id_col`` of the range with ``lo <= value <= hi`` to each row
    (as ``out_col``, default ``id_col``).

    Ranges must not overlap. The range join is made an equi-join: each
    range is listed once per ``bucket_width`` bucket it covers, each row
    carries the bucket of its value, and the bounds are checked after the
    equi-join. The range side, one row per range and bucket, is broadcast
    only when it has at most ``triploom.dim.broadcastMaxRows`` rows, counted
    after the buckets are listed (``bucket_rows`` gives that number if it is
    known); a larger one is joined by buckets with a shuffle, never by a
    nested loop.
    """
    value = F.col(value) if isinstance(value, str) else value
    spark = df.sparkSession
    r = (ranges.select(F.col(id_col).alias("_range_id"), F.col(lo).alias("_lo"),
                       F.col(hi).alias("_hi"))
         .withColumn("_rb", F.explode(F.sequence(
             F.floor(F.col("_lo") / bucket_width), F.floor(F.col("_hi") / bucket_width)))))
    rows = bucket_rows if bucket_rows is not None else r.count()
    if rows <= broadcast_max_rows(spark):
        r = F.broadcast(r)
    left = df.withColumn("_value", value).withColumn(
        "_vb", F.floor(F.col("_value") / bucket_width))
    cond = ((F.col("_vb") == F.col("_rb")) & (F.col("_value") >= F.col("_lo"))
            & (F.col("_value") <= F.col("_hi")))
    return (left.join(r, cond, how)
            .drop("_vb", "_rb", "_lo", "_hi", "_value")
            .withColumnRenamed("_range_id", out_col or id_col))


def assign_by_range_join(trips: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Trips with ``time_of_day`` and ``time_range_id`` found by the range join."""
    # a seeded range lies within one bucket of an hour
    rows = RANGES_PER_DAY if ranges is None else None
    ranges = ranges if ranges is not None else time_range_dim(trips.sparkSession)
    t = trips.withColumn("time_of_day", time_of_day("datetime"))
    return range_bucket_join(t, "time_of_day", ranges, out_col="time_range_id",
                             bucket_rows=rows)
