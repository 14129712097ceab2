"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed from the driver's tables at that scale factor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.operators import (
    assign_by_range_join, clean_trips, conform_dims, endpoint_points,
    time_range_assign, trip_fact, weekly_avg_bbox, weekly_avg_bbox_star,
    weekly_avg_by_region, weekly_avg_by_region_star, weekly_trip_counts,
)
from triploom.operators.audit import coord_time_fanout_audit
from triploom.operators.dims import (
    CT_KEYS, build_dim, name_members, point_members, trip_tuples, tuple_ids,
)
from triploom.operators.first_range import first_range_join
from triploom.operators.output import scalar_text, to_json_rows
from triploom.plans.oracle_sql import BOX, SECOND_LOAD_FROM
from triploom.session import materialize
from triploom.sources.fixture import lineitem_points, order_trips, trips_from_tables

Query = Callable[[SparkSession, str], DataFrame]


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips_from_tables(spark, sf_dir))


def q_clean_trips(spark, sf_dir):
    return _trips(spark, sf_dir).select(
        "trip_key", "region", "origin_coord", "destination_coord", "datetime",
        "datasource", "time_range_id", "origin_x", "origin_y", "destination_x",
        "destination_y")


def q_time_range_assign(spark, sf_dir):
    return time_range_assign(_trips(spark, sf_dir))


def q_range_bucket_join(spark, sf_dir):
    trips = trips_from_tables(spark, sf_dir).select("trip_key", "datetime")
    return assign_by_range_join(trips).select("trip_key", "time_of_day", "time_range_id")


def q_first_range_match(spark, sf_dir):
    """Line items by the first of the overlapping ranges that parts stand for;
    values below every range are reported with a null id."""
    key, size = F.col("p_partkey"), F.col("p_size")
    ranges = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        key.alias("id"), key.alias("low"), (key + size * size).alias("high"),
        (key * 7919 % 1009).alias("place"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") + F.col("l_linenumber") - 3)
        .alias("value"))
    return first_range_join(lines, "value", ranges, "low", "high", order=["place"],
                            on_missing="null", out_col="range_id")


def _dims(spark, sf_dir):
    return conform_dims(_trips(spark, sf_dir)).dims


def q_region_dim(spark, sf_dir):
    return build_dim(name_members(_trips(spark, sf_dir), "region"), ["description"]).df


def q_datasource_dim(spark, sf_dir):
    return build_dim(name_members(_trips(spark, sf_dir), "datasource"),
                     ["description"]).df


def q_coord_dim(spark, sf_dir):
    return build_dim(point_members(_trips(spark, sf_dir)), ["x", "y"]).df


def q_line_point_dim(spark, sf_dir):
    """A point dimension with as many members as there are line items' pairs
    of order and part: its ids are given out over many ranges."""
    points = lineitem_points(spark, sf_dir).distinct()
    return build_dim(points, ["x", "y"]).df


def q_coord_time_dim(spark, sf_dir):
    """coord_time from the batch's distinct tuples and the coord dimension
    built from those tuples' points (not from the whole trip set again)."""
    tuples = materialize(trip_tuples(_trips(spark, sf_dir)), "tuples")
    coord = build_dim(point_members(tuples), ["x", "y"])
    return build_dim(tuple_ids(tuples, coord).select(*CT_KEYS), CT_KEYS).df


def q_dim_upsert(spark, sf_dir):
    """coord_time after two loads: the first week, then the remaining days."""
    trips = _trips(spark, sf_dir)
    cut = F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz")
    first = conform_dims(trips.filter(F.col("datetime") < cut))
    second = conform_dims(trips.filter(F.col("datetime") >= cut), base=first.dims)
    return second.dims.coord_time.df


def _star(spark, sf_dir):
    trips = _trips(spark, sf_dir)
    conformed = conform_dims(trips)
    return trips, conformed


def q_trip_fact(spark, sf_dir):
    trips, conformed = _star(spark, sf_dir)
    return trip_fact(trips, conformed, keep=("trip_key",)).select(
        "trip_key", "region_id", "coord_time_id", "datasource_id", "datetime")


def q_weekly_trip_counts(spark, sf_dir):
    return weekly_trip_counts(_trips(spark, sf_dir))


def q_weekly_avg_by_region(spark, sf_dir):
    return weekly_avg_by_region(_trips(spark, sf_dir))


def q_weekly_avg_by_region_star(spark, sf_dir):
    trips, conformed = _star(spark, sf_dir)
    return weekly_avg_by_region_star(trip_fact(trips, conformed),
                                     conformed.dims.region.df)


def q_weekly_avg_by_region_orders(spark, sf_dir):
    return weekly_avg_by_region(order_trips(spark, sf_dir))


def q_weekly_avg_by_region_iso_year(spark, sf_dir):
    return weekly_avg_by_region(order_trips(spark, sf_dir), week="iso_year_week")


def q_endpoint_points(spark, sf_dir):
    dims = _dims(spark, sf_dir)
    return endpoint_points(dims.coord_time.df, dims.coord.df)


def q_weekly_avg_bbox(spark, sf_dir):
    return weekly_avg_bbox(_trips(spark, sf_dir), *BOX)


def q_weekly_avg_bbox_star(spark, sf_dir):
    trips, conformed = _star(spark, sf_dir)
    dims = conformed.dims
    return weekly_avg_bbox_star(trip_fact(trips, conformed), dims.coord_time.df,
                                dims.coord.df, *BOX)


def q_weekly_avg_bbox_star_trips(spark, sf_dir):
    trips, conformed = _star(spark, sf_dir)
    dims = conformed.dims
    return weekly_avg_bbox_star(trip_fact(trips, conformed), dims.coord_time.df,
                                dims.coord.df, *BOX, count="trips")


def q_weekly_avg_bbox_trips(spark, sf_dir):
    return weekly_avg_bbox(_trips(spark, sf_dir), *BOX, count="trips")


def q_weekly_avg_bbox_swapped(spark, sf_dir):
    x_a, y_a, x_b, y_b = BOX
    return weekly_avg_bbox(_trips(spark, sf_dir), str(x_b), str(y_b), str(x_a), str(y_a))


def q_weekly_avg_bbox_empty(spark, sf_dir):
    # blank corners count as 0: the box is the single point (0, 0)
    return weekly_avg_bbox(_trips(spark, sf_dir), "", None, " ", 0)


def q_coord_time_fanout_audit(spark, sf_dir):
    return coord_time_fanout_audit(_trips(spark, sf_dir))


def q_weekly_avg_bbox_text(spark, sf_dir):
    """The box metric as the text the result edge returns."""
    return scalar_text(weekly_avg_bbox(_trips(spark, sf_dir), *BOX), "weekly_avg_trips_bb")


def q_by_region_json(spark, sf_dir):
    return to_json_rows(weekly_avg_by_region(_trips(spark, sf_dir)))


def queries() -> dict[str, Query]:
    from triploom.plans.ingest_checks import (
        q_batch_ingest, q_compacted_ingest, q_ingest_progress, q_quarantine_ingest, q_stream_ingest,
        q_stream_delete, q_stream_weekly_bbox, q_stream_weekly_counts,
        q_weekly_avg_bbox_rollup, q_weekly_avg_by_region_rollup,
    )
    return {
        "clean_trips": q_clean_trips,
        "time_range_assign": q_time_range_assign,
        "range_bucket_join": q_range_bucket_join,
        "region_dim": q_region_dim,
        "datasource_dim": q_datasource_dim,
        "coord_dim": q_coord_dim,
        "line_point_dim": q_line_point_dim,
        "coord_time_dim": q_coord_time_dim,
        "dim_upsert": q_dim_upsert,
        "trip_fact": q_trip_fact,
        "weekly_trip_counts": q_weekly_trip_counts,
        "weekly_avg_by_region": q_weekly_avg_by_region,
        "weekly_avg_by_region_star": q_weekly_avg_by_region_star,
        "weekly_avg_by_region_orders": q_weekly_avg_by_region_orders,
        "weekly_avg_by_region_iso_year": q_weekly_avg_by_region_iso_year,
        "endpoint_points": q_endpoint_points,
        "weekly_avg_bbox": q_weekly_avg_bbox,
        "weekly_avg_bbox_star": q_weekly_avg_bbox_star,
        "weekly_avg_bbox_star_trips": q_weekly_avg_bbox_star_trips,
        "weekly_avg_bbox_trips": q_weekly_avg_bbox_trips,
        "weekly_avg_bbox_swapped": q_weekly_avg_bbox_swapped,
        "weekly_avg_bbox_empty": q_weekly_avg_bbox_empty,
        "coord_time_fanout_audit": q_coord_time_fanout_audit,
        "by_region_json": q_by_region_json,
        "weekly_avg_bbox_text": q_weekly_avg_bbox_text,
        "batch_ingest": q_batch_ingest,
        "compacted_ingest": q_compacted_ingest,
        "stream_ingest": q_stream_ingest,
        "quarantine_ingest": q_quarantine_ingest,
        "ingest_progress": q_ingest_progress,
        "stream_weekly_counts": q_stream_weekly_counts,
        "stream_weekly_bbox": q_stream_weekly_bbox,
        "stream_delete": q_stream_delete,
        "weekly_avg_by_region_rollup": q_weekly_avg_by_region_rollup,
        "weekly_avg_bbox_rollup": q_weekly_avg_bbox_rollup,
        "first_range_match": q_first_range_match,
    }
