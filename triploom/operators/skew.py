"""Lookup joins that stay balanced when one key holds much of the data.

A lookup (unique per key: a dimension, or the tuple -> coord_time id map)
joined to the fact:

* is broadcast when its exact row count is at most
  ``triploom.dim.broadcastMaxRows``; a broadcast hash join has no skew;
* is otherwise a shuffle join in which
  - every key whose exact row count in the fact exceeds the hot threshold
    is salted: its fact rows are spread over ``ceil(rows / threshold)``
    salt values by a hash of the row (deterministic, so retries agree), and
    only that key's lookup row is repeated once per salt;
  - fact rows with a NULL key (they can never match) are spread over many
    salt values instead of all hashing to one partition.
  The join is marked as a sort-merge join: Spark would otherwise go by the
  size of the files, and a side that is small as compressed Parquet (or before
  it is exploded) may be too large for the driver as a broadcast table.

The hot threshold is ``triploom.skew.hotKeyRows`` (default 5M rows), raised
when needed so that the hot-key list — at most total rows / threshold keys —
stays within ``triploom.skew.maxHotKeys`` (default 100,000 keys), which is
what makes that list safe to broadcast. AQE's own skew-join split remains
on as a second line.

The salt is a hash of the whole row, so that a retried task sends every
row to the same salt again. Trips read from files carry the number of their
line (``read_trips(with_place=True)``), so trips that are equal in every other
column are spread, too. Equal rows of other frames share one salt: a random
one would spread them, at the price of a nondeterministic shuffle that Spark
can only recover by re-running whole stages. They are left to AQE's skew split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triploom.operators.dense_ids import Numbered
from triploom.operators.dims import broadcast_max_rows

HOT_KEY_ROWS = 5_000_000
MAX_HOT_KEYS = 100_000
NULL_SPREAD = 64


def hot_key_rows(spark) -> int:
    return int(spark.conf.get("triploom.skew.hotKeyRows", str(HOT_KEY_ROWS)))


def max_hot_keys(spark) -> int:
    return max(int(spark.conf.get("triploom.skew.maxHotKeys", str(MAX_HOT_KEYS))), 1)


def hot_keys(key_counts: DataFrame, keys: list[str], total_rows: int) -> DataFrame:
    """(keys, _salts) of the keys whose exact row count exceeds the hot
    threshold, each with the number of salts that brings it under it."""
    spark = key_counts.sparkSession
    threshold = max(hot_key_rows(spark), -(-total_rows // max_hot_keys(spark)), 1)
    return (key_counts.filter(F.col("rows_in") > threshold)
            .select(*keys, F.ceil(F.col("rows_in") / threshold).cast("int").alias("_salts")))


def row_salt(rows: DataFrame, salts) -> Column:
    """A salt from 0 to ``salts`` - 1, from all columns of the row."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), salts)


def lookup_join(big: DataFrame, lookup: Numbered, keys: list[str],
                key_counts: DataFrame | None = None, total_rows: int | None = None,
                how: str = "left") -> DataFrame:
    """``big`` joined to the unique-per-key ``lookup`` on ``keys``.

    ``key_counts`` (keys + ``rows_in``) gives the exact rows per key in
    ``big`` and ``total_rows`` their sum; without them the join is left to
    Spark (AQE) when it cannot be broadcast.
    """
    spark = big.sparkSession
    limit = broadcast_max_rows(spark)
    if lookup.rows <= limit:
        return big.join(F.broadcast(lookup.df), keys, how)
    if key_counts is None or total_rows is None:
        return big.join(lookup.df, keys, how)
    # at most total_rows / threshold <= maxHotKeys keys, by the choice of
    # threshold: a proven bound, so the list is broadcast
    hot = F.broadcast(hot_keys(key_counts, keys, total_rows))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salted_big = (big.join(hot, keys, "left")
                  .withColumn("_salt", F.when(any_null, row_salt(big, F.lit(NULL_SPREAD)))
                              .when(F.col("_salts").isNotNull(),
                                    row_salt(big, F.col("_salts")))
                              .otherwise(F.lit(0)).cast("int"))
                  .drop("_salts"))
    salted_lookup = (lookup.df.join(hot, keys, "left")
                     .withColumn("_salt", F.explode(F.sequence(
                         F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
                     .drop("_salts"))
    return salted_big.join(salted_lookup.hint("merge"), keys + ["_salt"], how).drop("_salt")
