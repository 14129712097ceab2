"""Connected components of a link table, by alternating star steps.

Every step replaces the links around a node by links to the smallest node
of its neighbourhood (first for the larger neighbours, then for the smaller
ones), until nothing changes: each component is then a star around its
smallest node. Steps are joins and pre-aggregated minima over the link
table, so a node with very many links needs no task of its own, and each
step's links are stored before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.session import materialize


def _fingerprint(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), the component
    being its smallest node. Null and self links are left out."""
    now = materialize(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _fingerprint(now)
    while seen[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")) \
            .withColumn("m", F.least("u", "m"))
        large = (both.filter("b > a").join(least, F.col("a") == F.col("u"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        # links that have no smaller end of their own
        large = large.filter("a <> b").distinct()
        small_least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (large.join(small_least, F.col("a") == F.col("u"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(small_least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        now = materialize(small.filter("a <> b").distinct(), "links")
        last, seen = seen, _fingerprint(now)
        if seen == last:
            break
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
