"""The first of several overlapping ranges that holds a value.

A whole-number range is cut into aligned blocks of 1, 2, 4, ... values that
cover just it, at most two of each size however wide it is. A block keeps
only the first range that covers it, so the block table has one row a block
whatever the ranges' overlap, and a value meets at most one row per block
size: its first range is the first among those. No value is compared with
all ranges that hold it, and nothing is a nested loop.

Values are looked up once each: a value that a third of all rows share is one
row of the lookup, and goes back to its rows by a salted join
(:mod:`triploom.operators.skew`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom.operators.dense_ids import Numbered
from triploom.operators.skew import lookup_join
from triploom.session import materialize

SIZES = 63                       # block sizes 2**0 to 2**62
MISSING = ("error", "null")
SHOWN = 5


class NoRangeError(ValueError):
    """A value that no range holds."""


def _whole(df: DataFrame, col: str) -> None:
    if not isinstance(df.schema[col].dataType, T.IntegralType):
        raise TypeError(f"{col} must be a whole number, not {df.schema[col].dataType}")


def range_blocks(ranges: DataFrame, lo: str, hi: str, id_col: str,
                 order: list[str]) -> DataFrame:
    """(_size, _block, _first): the blocks that make up the ranges, each with
    the first range (by ``order``, then id) that covers it. A range whose end
    is before its start, or null, covers nothing."""
    size, a, b = F.col("_size"), F.col("_a"), F.col("_b")
    r = ranges.select(F.col(lo).cast("long").alias("_lo"), F.col(hi).cast("long").alias("_hi"),
                      F.struct(*order, F.col(id_col).alias("_id")).alias("_range"))
    # blocks of a size run from the range's start rounded up to its end
    # rounded down; one at an odd place on either side isn't in a larger block
    cut = (r.filter(F.col("_lo") <= F.col("_hi"))
           .withColumn("_size", F.explode(F.sequence(F.lit(0), F.lit(SIZES - 1))))
           .withColumn("_a", -F.expr("shiftright(-_lo, _size)"))
           .withColumn("_b", F.expr("shiftright(_hi + 1, _size)")).filter(a < b))
    ends = F.array(F.when(F.pmod(a, F.lit(2)) == 1, a), F.when(F.pmod(b, F.lit(2)) == 1, b - 1))
    return (cut.select(size, F.explode(ends).alias("_block"), "_range")
            .filter(F.col("_block").isNotNull())
            .groupBy("_size", "_block").agg(F.min("_range").alias("_first")))


def first_range_join(df: DataFrame, value: str, ranges: DataFrame, lo: str = "time_from",
                     hi: str = "time_to", id_col: str = "id", order: list[str] | None = None,
                     on_missing: str = "error", out_col: str | None = None) -> DataFrame:
    """``df`` with the id (``out_col``) of the first range that holds ``value``.

    First is by the columns ``order`` of ``ranges``, then by id. ``value``
    and the bounds are whole numbers under 2**62; bounds are inside. Where no
    range holds the value, or it is null: ``on_missing="error"`` raises
    :class:`NoRangeError` (before any row is returned), ``"null"`` gives a
    null id. Every row of ``df`` comes back once, with its columns.
    """
    if on_missing not in MISSING:
        raise ValueError(f"on_missing must be one of {MISSING}")
    _whole(df, value)
    _whole(ranges, lo)
    _whole(ranges, hi)
    out_col = out_col or id_col
    blocks = materialize(range_blocks(ranges, lo, hi, id_col, order or []), "range-blocks")
    # one row per block size, of 63
    sizes = {r["_size"]: r["n"] for r in blocks.groupBy("_size").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    values = materialize(df.groupBy(F.col(value).cast("long").alias("_value")).agg(
        F.count(F.lit(1)).alias("rows_in")), "range-values")
    asked = (values.filter(F.col("_value").isNotNull())
             .withColumn("_size", F.explode(F.array(*map(F.lit, sorted(sizes))) if sizes
                                            else F.array().cast("array<int>")))
             .withColumn("_block", F.expr("shiftright(_value, _size)"))
             .select("_size", "_block", "_value"))
    keys = ["_size", "_block"]
    # a wide range's block is met by all values under it: salted when it's hot
    counts = asked.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_in"))
    n_values = values.count()
    met = lookup_join(asked, Numbered(blocks, sum(sizes.values())), keys, counts,
                      n_values * max(len(sizes), 1), how="inner")
    first = materialize(met.groupBy("_value").agg(F.min("_first").alias("_first")).select(
        "_value", F.col("_first._id").alias("_range_id")), "first-ranges")
    if on_missing == "error":
        # not broadcast by the size of its files: there may be a row a value
        lost = values.join(first.hint("merge"), "_value", "left").filter(F.col("_range_id").isNull()).select(
            "_value", "rows_in").orderBy("_value").limit(SHOWN).collect()
        if lost:
            raise NoRangeError("in no range: " + ", ".join(
                f"{r['_value']} ({r['rows_in']} rows)" for r in lost))
    rows = df.withColumn("_value", F.col(value).cast("long"))
    total = values.agg(F.sum("rows_in")).first()[0] or 0
    found = lookup_join(rows, Numbered(first, n_values), ["_value"], values, total)
    return found.drop("_value").withColumnRenamed("_range_id", out_col)
