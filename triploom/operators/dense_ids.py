"""Ordered dense surrogate ids, assigned in parallel.

The distinct keys are range-partitioned and sorted within each partition;
the per-partition row counts (one number per partition) give each
partition's offset, and the ids follow as ``start + offset + position``. No
window runs over all keys, and no task holds more than its range of them:
the number of ranges follows the number of keys, one per
``triploom.denseIds.rowsPerTask`` keys (default 10,000) while that stays
within the session's shuffle partitions, and beyond that as many as keep a
range under a million keys.

With more than one range the sorted keys are written once as a table in the
shared checkpoint folder, because range bounds come from sampling and a
recomputation could place rows differently. A single range has no bounds:
its ids are a function of the key set alone.

Ids are BIGINT.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.session import materialize

ROWS_PER_TASK = 10_000
MOST_ROWS_PER_TASK = 1_000_000


@dataclass
class Numbered:
    """Keys with their ids, how many there are, and (when known) the
    largest id."""

    df: DataFrame
    rows: int
    max_id: int | None = None


def range_count(spark, rows: int) -> int:
    """Range partitions for so many keys."""
    each = int(spark.conf.get("triploom.denseIds.rowsPerTask", str(ROWS_PER_TASK)))
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(-(-rows // max(each, 1)), max(usual, -(-rows // MOST_ROWS_PER_TASK))))


def dense_ids(keys: DataFrame, key_cols: list[str], at_most: int, start_after: int = 0,
              id_col: str = "id") -> DataFrame:
    """Distinct ``keys`` numbered 1, 2, ... (plus ``start_after``) in key
    order; ``at_most`` is their count or a bound for it. Returns the id
    first, then the key columns."""
    cols = [F.col(c) for c in key_cols]
    spark = keys.sparkSession
    n = range_count(spark, at_most)
    placed = (keys.select(*key_cols).repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("_pos", F.monotonically_increasing_id()))
    if n == 1:
        return placed.select((F.col("_pos") + (start_after + 1)).alias(id_col), *key_cols)
    tagged = materialize(placed.withColumn("_pid", F.spark_partition_id()), "dense-ids")
    # one row per range: bounded by the partition count, not by the data
    shift, before = [], start_after
    for r in sorted(tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"),
                                               F.min("_pos").alias("first")).collect()):
        shift.append((r["_pid"], before - r["first"]))
        before += r["n"]
    shift = spark.createDataFrame(shift, "_pid int, _shift long")
    return tagged.join(F.broadcast(shift), "_pid").select(
        (F.col("_pos") + F.col("_shift") + 1).alias(id_col), *key_cols)


def assign_dense_ids(keys: DataFrame, key_cols: list[str], start_after: int = 0,
                     id_col: str = "id", rows: int | None = None) -> Numbered:
    """:func:`dense_ids` with the exact number of keys, counted unless
    ``rows`` gives it. ``keys`` must not repeat a key."""
    total = keys.count() if rows is None else rows
    return Numbered(dense_ids(keys, key_cols, total, start_after, id_col), total,
                    start_after + total)
