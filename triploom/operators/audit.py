"""Reconciliation with the fact counts of the system being replaced.

That system added one coord_time member per trip rather than per distinct
(origin, destination, time range) triple, and its fact join then wrote
m * m rows for a triple seen m times in a chunk. Here every triple is one
member and every trip one fact row; this audit lists, per triple, the trip
count m and the m * m rows the old load would have written for a one-chunk
load, so old and new numbers can be reconciled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.operators.dims import TUPLE_COLS


def coord_time_fanout_audit(trips: DataFrame) -> DataFrame:
    """(origin_x, origin_y, destination_x, destination_y, time_range_id,
    trips, legacy_fact_rows) per distinct triple of a cleaned batch."""
    return (trips.groupBy(*TUPLE_COLS)
            .agg(F.count(F.lit(1)).alias("trips"))
            .withColumn("legacy_fact_rows", F.col("trips") * F.col("trips")))
