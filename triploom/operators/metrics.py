"""Weekly trip metrics: average trips per week by region and inside a box.

Semantics kept from the system being replaced (stated once here):

* the mean is taken over weeks that have trips; empty weeks do not lower it;
* the default week key is the ISO week number without the year, so week 1
  of every year is one group (``week="iso_year_week"`` keeps years apart);
* the box metric counts trip endpoints by default: a trip with both ends in
  the box counts twice unless both ends are the same point
  (``count="trips"`` counts each trip once);
* a box with no hits gives 0.0.

Every metric aggregates before it joins or shuffles: the partial
aggregation runs map-side, so a hot region or week collapses to one row per
task before the exchange, and the joins that follow see aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.functions import Box, in_box, week_key

COUNT_MODES = ("endpoints", "trips")


def _week_cols(kind: str) -> list[str]:
    return ["iso_year", "week"] if kind == "iso_year_week" else ["week"]


# --------------------------------------------------------------------------
# flat form: over cleaned trips (region text and coordinates on each row)
# --------------------------------------------------------------------------

def weekly_trip_counts(trips: DataFrame, group_col: str = "region",
                       ts_col: str = "datetime", week: str = "week") -> DataFrame:
    """(group, [iso_year,] week, num_trips): trips per group and week.

    Counts non-null group values, so rows with no group give a 0 count.
    """
    return (trips.groupBy(F.col(group_col), *week_key(ts_col, week))
            .agg(F.count(group_col).alias("num_trips")))


def weekly_avg_by_region(trips: DataFrame, week: str = "week",
                         group_col: str = "region", ts_col: str = "datetime") -> DataFrame:
    """(region, weekly_avg_trips) ordered by the average, then the name."""
    counts = weekly_trip_counts(trips.filter(F.col(group_col).isNotNull()),
                                group_col, ts_col, week)
    return (counts.groupBy(F.col(group_col).alias("region"))
            .agg(F.avg("num_trips").alias("weekly_avg_trips"))
            .orderBy("weekly_avg_trips", "region"))


def endpoint_contribution(box: Box, count: str = "endpoints"):
    """Per-trip number of counted hits for the box (0 when outside)."""
    if count not in COUNT_MODES:
        raise ValueError(f"count must be one of {COUNT_MODES}")
    o = in_box("origin_x", "origin_y", box)
    d = in_box("destination_x", "destination_y", box)
    if count == "trips":
        return F.when(o | d, 1).otherwise(0), o | d
    same = ((F.col("origin_x") == F.col("destination_x"))
            & (F.col("origin_y") == F.col("destination_y")))
    return o.cast("int") + (d & ~same).cast("int"), o | d


def weekly_avg_bbox(trips: DataFrame, x_a=None, y_a=None, x_b=None, y_b=None,
                    count: str = "endpoints", week: str = "week",
                    ts_col: str = "datetime") -> DataFrame:
    """One row ``weekly_avg_trips_bb``: average weekly hits inside the box.

    Corners are any two opposite corners; blank or missing counts as 0.
    Every trip adds its hit count (0 outside) to its week in one map-side
    aggregation; weeks whose sum is 0 had no hit and are dropped, which is
    the same as filtering trips first (a hit always adds at least 1) but
    keeps the coordinates computed once per row instead of inlined into a
    row filter. The shuffle carries one (week, partial sum) row per task.
    """
    box = Box.from_corners(x_a, y_a, x_b, y_b)
    contrib, _ = endpoint_contribution(box, count)
    per_week = (trips.groupBy(*week_key(ts_col, week))
                .agg(F.sum(contrib).alias("num_trips"))
                .filter(F.col("num_trips") > 0))
    return per_week.agg(
        F.coalesce(F.avg("num_trips"), F.lit(0.0)).alias("weekly_avg_trips_bb"))


# --------------------------------------------------------------------------
# star form: over the trip fact and its dimensions
# --------------------------------------------------------------------------

def weekly_avg_by_region_star(trip: DataFrame, region: DataFrame,
                              week: str = "week") -> DataFrame:
    """Region metric from the fact: count per (region_id, week) first, then
    join the (tiny) aggregate to the region dimension by id."""
    counts = (trip.groupBy("region_id", *week_key("datetime", week))
              .agg(F.count("region_id").alias("num_trips")))
    named = counts.join(region.select(F.col("id").alias("region_id"), "description"),
                        "region_id", "inner")
    return (named.groupBy(F.col("description").alias("region"))
            .agg(F.avg("num_trips").alias("weekly_avg_trips"))
            .orderBy("weekly_avg_trips", "region"))


def endpoint_points(coord_time: DataFrame, coord: DataFrame) -> DataFrame:
    """(id, x, y): the distinct endpoints of every coord_time member."""
    c = coord.select(F.col("id").alias("coord_id"), "x", "y")
    origin = coord_time.select("id", F.col("origin_coord_id").alias("coord_id"))
    # equal points share one coord id, so leaving out a destination equal to
    # its origin makes (id, coord_id) distinct without a global distinct.
    dest = (coord_time.filter(F.col("dest_coord_id") != F.col("origin_coord_id"))
            .select("id", F.col("dest_coord_id").alias("coord_id")))
    return origin.unionByName(dest).join(c, "coord_id").select("id", "x", "y")


def _box_hits(coord_time: DataFrame, coord: DataFrame, box: Box,
              count: str) -> DataFrame:
    """(coord_time_id, hits): members with at least one endpoint in the box.

    One scan of the members; each endpoint column is left-joined to the set
    of coordinates in the box (the filter reaches the coord scan).
    """
    inside = coord.filter(in_box("x", "y", box)).select(F.col("id").alias("_c"))
    o = inside.select(F.col("_c").alias("_o"))
    d = inside.select(F.col("_c").alias("_d"))
    ct = coord_time.select("id", "origin_coord_id", "dest_coord_id")
    both = (ct.join(o, F.col("origin_coord_id") == F.col("_o"), "left")
            .join(d, F.col("dest_coord_id") == F.col("_d"), "left")
            .filter(F.col("_o").isNotNull() | F.col("_d").isNotNull()))
    if count == "trips":
        hits = F.lit(1)
    else:
        # equal ends share one coord id and count once
        apart = F.col("origin_coord_id") != F.col("dest_coord_id")
        hits = (F.col("_o").isNotNull().cast("int")
                + (F.col("_d").isNotNull() & apart).cast("int"))
    return both.select(F.col("id").alias("coord_time_id"), hits.alias("hits"))


def box_hits_side(coord_time: DataFrame, coord: DataFrame, box: Box, count: str) -> DataFrame:
    """The members that touch the box, written once (two numbers a member),
    which counts them; marked for broadcast under the size limit."""
    from triploom.operators.dims import broadcast_max_rows
    from triploom.session import materialize

    hits = materialize(_box_hits(coord_time, coord, box, count), "box-hits")
    return F.broadcast(hits) if hits.count() <= broadcast_max_rows(hits.sparkSession) else hits


def weekly_avg_bbox_star(trip: DataFrame, coord_time: DataFrame, coord: DataFrame,
                         x_a=None, y_a=None, x_b=None, y_b=None,
                         count: str = "endpoints", week: str = "week") -> DataFrame:
    """Box metric from the star tables.

    The box filter reaches the ``coord`` scan, and the members touching the
    box are found in one scan of ``coord_time`` and written once (two
    numbers a member), which also counts them. Then, by their exact number:

    * at most ``triploom.dim.broadcastMaxRows`` members (the usual case for
      a box): the hit list is broadcast and the fact is filtered by it in
      the scan stage, so only matching trips reach the weekly aggregation
      and the fact is never shuffled;
    * more: the fact's two columns are joined to the hit list by key, after
      which only matching trips are left to aggregate.
    """
    if count not in COUNT_MODES:
        raise ValueError(f"count must be one of {COUNT_MODES}")
    hits = box_hits_side(coord_time, coord, Box.from_corners(x_a, y_a, x_b, y_b), count)
    per_week = (trip.select("coord_time_id", "datetime").join(hits, "coord_time_id")
                .groupBy(*week_key("datetime", week))
                .agg(F.sum("hits").alias("num_trips")))
    return per_week.agg(
        F.coalesce(F.avg("num_trips"), F.lit(0.0)).alias("weekly_avg_trips_bb"))
