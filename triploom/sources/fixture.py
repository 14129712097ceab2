"""Raw trip records derived from the driver's TPC-H-like tables.

One trip per ``events`` row: the event's customer gives the region (through
nation and region), the event type is the data source, the event time the
trip time, and two small integer domains of the event and user ids give the
origin and destination points. The small domains force repeated
(origin, destination, time range) triples, equal ends and trips with both
ends in a box; region names are padded or missing on a fixed share of rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def point_text(a: Column, b: Column) -> Column:
    """'POINT (a.bb317 (a+40).(99-b)683)' with b zero-padded to two digits.

    The fixed tails keep every value away from a rounding tie.
    """
    return F.concat(
        F.lit("POINT ("), a.cast("string"), F.lit("."),
        F.lpad(b.cast("string"), 2, "0"), F.lit("317 "),
        (a + 40).cast("string"), F.lit("."),
        F.lpad((F.lit(99) - b).cast("string"), 2, "0"), F.lit("683)"))


def trips_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips (region, origin_coord, destination_coord, datetime,
    datasource) plus ``trip_key``, one row per event.

    ``datetime`` is already a TIMESTAMP_NTZ here; the cleaning step accepts
    text or timestamps.
    """
    events = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # customer -> region name is a lookup of one row per customer; it is
    # joined to the events by key and Spark chooses the join strategy from
    # the measured sizes (AQE), so a large customer table is not broadcast.
    cust_region = (customer
                   .join(nation, customer.c_nationkey == nation.n_nationkey)
                   .join(region, nation.n_regionkey == region.r_regionkey)
                   .select("c_custkey", "r_name"))
    e = events.join(cust_region, events.user_id == cust_region.c_custkey)
    eid, uid = F.col("event_id"), F.col("user_id")
    region_text = (F.when(eid % 97 == 0, F.lit(None).cast("string"))
                   .when(eid % 10 == 0, F.concat(F.lit("  "), F.col("r_name"), F.lit(" ")))
                   .otherwise(F.col("r_name")))
    return e.select(
        eid.alias("trip_key"),
        region_text.alias("region"),
        point_text(uid % 4, eid % 5).alias("origin_coord"),
        point_text(eid % 3, uid % 5).alias("destination_coord"),
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("datasource"),
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(region, datetime) per order: the customer's region name and the order
    date. Spans several years, for the week-key choices."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (orders
            .join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("r_name").alias("region"),
                    F.col("o_orderdate").cast("timestamp_ntz").alias("datetime")))


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(x, y) of every line item: its order's and its part's key as a point."""
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return items.select(F.col("l_orderkey").cast("double").alias("x"),
                        F.col("l_partkey").cast("double").alias("y"))
