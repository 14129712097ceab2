"""The trip fact: one row per cleaned trip with its dimension ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.operators.dense_ids import Numbered
from triploom.operators.dims import TUPLE_COLS, Conformed
from triploom.operators.skew import lookup_join

FACT_COLUMNS = ["region_id", "coord_time_id", "datasource_id", "datetime"]


def trip_fact(trips: DataFrame, conformed: Conformed,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows for a cleaned batch.

    Region and data source are looked up by their stripped names (left
    joins: a trip without a name keeps a NULL id). The coord_time id comes
    from one join on the five tuple columns against the batch's lookup, so
    the fact is shuffled at most once (not once per endpoint). Each lookup
    is broadcast under the size limit, else salted on its hot keys with the
    exact per-key counts of the batch (:mod:`triploom.operators.skew`).
    ``keep`` passes extra trip columns through.
    """
    c = conformed
    counts = c.key_counts or {}
    region = Numbered(c.dims.region.df.select(F.col("id").alias("region_id"),
                                              F.col("description").alias("region")),
                      c.dims.region.rows)
    source = Numbered(c.dims.datasource.df.select(F.col("id").alias("datasource_id"),
                                                  F.col("description").alias("datasource")),
                      c.dims.datasource.rows)
    fact = trips.select("region", "datasource", *TUPLE_COLS, "datetime", *keep)
    fact = lookup_join(fact, region, ["region"], counts.get("region"), c.total_rows)
    fact = lookup_join(fact, source, ["datasource"], counts.get("datasource"), c.total_rows)
    fact = lookup_join(fact, c.coord_time_map, TUPLE_COLS, counts.get("tuple"), c.total_rows)
    return fact.select(*FACT_COLUMNS, *keep)
