"""Weekly totals kept per ingest batch, so that metrics needn't read trips.

Each batch adds, beside its trips, how many of them there are per (region,
week) and per (coord_time member, week): one aggregation over the batch with
map-side partials. Totals of batches add up, so a metric sums them over the
committed batches. Weeks are kept with their ISO year; the default week key
drops it when it sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.functions import Box, week_key
from triploom.operators.metrics import COUNT_MODES, box_hits_side

REGION, PAIR = "region", "pair"
WEEK_COLS = ["iso_year", "week"]


def weekly_rollup(trip: DataFrame) -> DataFrame:
    """(region_id, coord_time_id, iso_year, week, num_trips, grain): trips per
    region and week, and per coord_time member and week. Trips without a
    region count only for their member; those without a time in no week."""
    t = trip.filter(F.col("datetime").isNotNull()).select(
        "region_id", "coord_time_id", *week_key("datetime", "iso_year_week"))
    keys = ["region_id", "coord_time_id", *WEEK_COLS]
    sets = [["region_id", *WEEK_COLS], ["coord_time_id", *WEEK_COLS]]
    # grouping_id has a bit per key that a set leaves out, the first key highest
    counted = t.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("num_trips"))
    grain = F.when(F.col("_gid") == 4, REGION).otherwise(PAIR)
    return (counted.withColumn("grain", grain)
            .filter((F.col("grain") == PAIR) | F.col("region_id").isNotNull())
            .filter((F.col("grain") == REGION) | F.col("coord_time_id").isNotNull())
            .select(*keys, "num_trips", "grain"))


def _weeks(kind: str) -> list[str]:
    return WEEK_COLS if week_key("datetime", kind) and kind == "iso_year_week" else ["week"]


def weekly_avg_by_region_rollup(weeks: DataFrame, region: DataFrame,
                                week: str = "week") -> DataFrame:
    """The region metric (region, weekly_avg_trips) from the weekly totals."""
    counts = (weeks.filter(F.col("grain") == REGION).groupBy("region_id", *_weeks(week))
              .agg(F.sum("num_trips").alias("num_trips")))
    named = counts.join(region.select(F.col("id").alias("region_id"), "description"), "region_id")
    return (named.groupBy(F.col("description").alias("region"))
            .agg(F.avg("num_trips").alias("weekly_avg_trips"))
            .orderBy("weekly_avg_trips", "region"))


def weekly_avg_bbox_rollup(weeks: DataFrame, coord_time: DataFrame, coord: DataFrame,
                           x_a=None, y_a=None, x_b=None, y_b=None, count: str = "endpoints",
                           week: str = "week") -> DataFrame:
    """The box metric (weekly_avg_trips_bb) from the weekly totals: the
    members that touch the box, times their trips of each week."""
    if count not in COUNT_MODES:
        raise ValueError(f"count must be one of {COUNT_MODES}")
    hits = box_hits_side(coord_time, coord, Box.from_corners(x_a, y_a, x_b, y_b), count)
    per_week = (weeks.filter(F.col("grain") == PAIR)
                .select("coord_time_id", *_weeks(week), "num_trips").join(hits, "coord_time_id")
                .groupBy(*_weeks(week))
                .agg(F.sum(F.col("hits") * F.col("num_trips")).alias("num_trips")))
    return per_week.agg(
        F.coalesce(F.avg("num_trips"), F.lit(0.0)).alias("weekly_avg_trips_bb"))
