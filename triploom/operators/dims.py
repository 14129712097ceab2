"""Dimensions of the star schema and their incremental growth.

A dimension member is a distinct natural key (region or data-source name,
rounded point, or origin/destination/time-range triple). A new batch adds
only the keys not stored yet, numbered after the stored maximum id in key
order (:mod:`triploom.operators.dense_ids`).

Lookups into a dimension are broadcast only when its row count — known
exactly, since every dimension here is built through ``Numbered`` or read
with a count — is at most ``triploom.dim.broadcastMaxRows`` (default one
million); above that the join is left to Spark (sort-merge, or a broadcast
chosen by AQE from the measured size). The fact's lookups add salting of
hot keys on top (:mod:`triploom.operators.skew`).
"""

from __future__ import annotations

import contextvars
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom import schema as S
from triploom.functions import strip_text
from triploom.operators.dense_ids import Numbered, assign_dense_ids

BROADCAST_MAX_ROWS = 1_000_000
POINT_COLS = ["origin_x", "origin_y", "destination_x", "destination_y"]
TUPLE_COLS = POINT_COLS + ["time_range_id"]
CT_KEYS = S.DIM_KEYS["coord_time"]


def broadcast_max_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("triploom.dim.broadcastMaxRows", str(BROADCAST_MAX_ROWS)))


def lookup(dim: Numbered) -> DataFrame:
    """The dimension frame, marked for broadcast when its size allows."""
    if dim.rows <= broadcast_max_rows(dim.df.sparkSession):
        return F.broadcast(dim.df)
    return dim.df


def empty_dim(spark: SparkSession, name: str) -> Numbered:
    return Numbered(spark.createDataFrame([], S.STAR_TABLES[name]), 0)


# -------------------------------------------------------------- members ---

def name_members(trips: DataFrame, col: str) -> DataFrame:
    """Distinct stripped, non-null names of ``col`` as ``description``."""
    return (trips.select(strip_text(col).alias("description"))
            .filter(F.col("description").isNotNull()).distinct())


def point_members(trips: DataFrame) -> DataFrame:
    """Distinct (x, y) of all origins and destinations, in one scan."""
    return (trips.selectExpr(
                "stack(2, origin_x, origin_y, destination_x, destination_y) as (x, y)")
            .filter(F.col("x").isNotNull() & F.col("y").isNotNull()).distinct())


def trip_tuples(trips: DataFrame) -> DataFrame:
    """Distinct (origin point, destination point, time range) of the batch."""
    return trips.select(*TUPLE_COLS).distinct()


def tuple_ids(tuples: DataFrame, coord: Numbered, n_tuples: int | None = None) -> DataFrame:
    """Tuples with the coord ids of both ends.

    The coord lookup is broadcast under the size limit. Above it, with the
    tuple count known, each end is joined through the salted lookup join:
    a hub point shared by many tuples is spread over several tasks (its
    per-point tuple counts come from a map-side aggregate of the tuples).
    """
    from triploom.operators.skew import lookup_join

    ends = {"origin": ("origin_x", "origin_y", "origin_coord_id"),
            "destination": ("destination_x", "destination_y", "dest_coord_id")}
    out = tuples
    for x, y, id_col in ends.values():
        side = Numbered(coord.df.select(F.col("x").alias(x), F.col("y").alias(y),
                                        F.col("id").alias(id_col)), coord.rows)
        counts = None
        if n_tuples is not None and coord.rows > broadcast_max_rows(tuples.sparkSession):
            counts = tuples.groupBy(x, y).agg(F.count(F.lit(1)).alias("rows_in"))
        out = lookup_join(out, side, [x, y], counts, n_tuples, how="inner")
    return out


# --------------------------------------------------------------- upsert ---

@dataclass
class Upsert:
    """A dimension after a batch: all members, and the members it added."""

    all: Numbered
    new: Numbered


def dim_upsert(base: Numbered, members: DataFrame, key_cols: list[str],
               member_rows: int | None = None) -> Upsert:
    """Add the members of ``members`` missing from ``base``.

    New ids start at ``max(base.id) + 1`` (1 for an empty base) and follow
    key order. The new keys are found with an anti join on the key columns
    (never a full outer join); ``base`` is broadcast only under the size
    limit. ``member_rows``, the exact member count if known, saves a count
    when the base is empty.
    """
    if base.rows:
        base_max = base.max_id if base.max_id is not None else (
            base.df.agg(F.max("id")).first()[0] or 0)
        new_keys = members.join(lookup(base).select(*key_cols), key_cols, "left_anti")
    else:
        base_max, new_keys = 0, members
    new = assign_dense_ids(new_keys, key_cols, start_after=base_max,
                           rows=None if base.rows else member_rows)
    if not base.rows:
        return Upsert(new, new)
    everything = base.df.select("id", *key_cols).unionByName(new.df)
    return Upsert(Numbered(everything, base.rows + new.rows), new)


def build_dim(members: DataFrame, key_cols: list[str]) -> Numbered:
    """A dimension from scratch: members numbered 1.. in key order."""
    return assign_dense_ids(members, key_cols)


# ------------------------------------------------------- the whole star ---

@dataclass
class StarDims:
    region: Numbered
    datasource: Numbered
    coord: Numbered
    coord_time: Numbered

    @classmethod
    def empty(cls, spark: SparkSession) -> "StarDims":
        return cls(*(empty_dim(spark, n) for n in ("region", "datasource", "coord",
                                                    "coord_time")))


@dataclass
class Conformed:
    """Dimensions after the batch, the members it added, the lookup from a
    trip's points and time range to its coord_time id, and exact row counts
    of the batch: per file, per member (``key_counts``) and in total."""

    dims: StarDims
    added: StarDims
    coord_time_map: Numbered
    file_counts: DataFrame | None = None
    key_counts: dict[str, DataFrame] | None = None
    total_rows: int | None = None


# grouping sets of the member pass; grouping_id sets one bit per column
# left out of a set, in the order of MEMBER_COLS
MEMBER_COLS = ["region", "datasource", *TUPLE_COLS, "source_file"]
MEMBER_SETS = {"region": ["region"], "datasource": ["datasource"],
               "tuple": TUPLE_COLS, "file": ["source_file"]}


def _gid(cols: list[str]) -> int:
    n = len(MEMBER_COLS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(MEMBER_COLS) if c not in cols)


def batch_members(trips: DataFrame) -> DataFrame:
    """Every member set of a batch from one scan and one shuffle.

    Grouping sets over (region), (datasource), (tuple) and (source file):
    rows are expanded per set and aggregated map-side before the shuffle,
    so a hot member costs one row per task. The result — distinct names,
    distinct tuples and per-file counts — is written once and read by all
    dimension steps.
    """
    t = trips
    if "source_file" not in t.columns:
        t = t.withColumn("source_file", F.lit(None).cast("string"))
    rejected = (F.col("reject_reason").isNotNull().cast("long")
                if "reject_reason" in t.columns else F.lit(0).cast("long"))
    t = t.select(strip_text("region").alias("region"),
                 strip_text("datasource").alias("datasource"),
                 *TUPLE_COLS, "source_file", rejected.alias("_rejected"))
    if "reject_reason" in trips.columns:
        # only accepted rows add members; rejected ones are only counted
        keep = F.col("_rejected") == 0
        t = t.withColumns({c: F.when(keep, F.col(c)) for c in MEMBER_COLS[:-1]})
    sets = [MEMBER_SETS[k] for k in ("region", "datasource", "tuple", "file")]
    return (t.groupingSets(sets, *MEMBER_COLS)
            .agg(F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("rows_in"),
                 F.sum("_rejected").alias("rows_rejected")))


@dataclass
class BatchMembers:
    """The stored member table of a batch, and its exact sizes."""

    names: dict[str, DataFrame]
    tuples: DataFrame
    sizes: dict[str, int]
    total_rows: int
    file_counts: DataFrame
    key_counts: dict[str, DataFrame]


def read_members(trips: DataFrame) -> BatchMembers:
    """Every member set of a cleaned batch, written once."""
    from triploom.session import materialize

    members = materialize(batch_members(trips), "batch-members")

    def of(kind: str) -> DataFrame:
        return members.filter(F.col("_gid") == _gid(MEMBER_SETS[kind]))

    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in TUPLE_COLS])
    # exact sizes from the stored member table (one row per grouping set):
    # non-null members per set and rows in the batch, in one small job
    present = {"region": F.col("region").isNotNull(),
               "datasource": F.col("datasource").isNotNull(), "tuple": complete}
    found = {r["_gid"]: r for r in members.groupBy("_gid").agg(
        F.sum("rows_in").alias("rows"),
        *[F.count_if(cond).alias(k) for k, cond in present.items()]).collect()}

    def size(kind: str, field: str) -> int:
        row = found.get(_gid(MEMBER_SETS[kind]))
        return (row[field] or 0) if row is not None else 0

    tuples = of("tuple").filter(complete)
    return BatchMembers(
        {k: of(k).select(F.col(k).alias("description")).filter(
            F.col("description").isNotNull()) for k in ("region", "datasource")},
        tuples.select(*TUPLE_COLS), {k: size(k, k) for k in present}, size("tuple", "rows"),
        of("file").select("source_file", "rows_in", "rows_rejected"),
        {"region": of("region").select("region", "rows_in"),
         "datasource": of("datasource").select("datasource", "rows_in"),
         "tuple": tuples.select(*TUPLE_COLS, "rows_in")})


def conform_dims(trips: DataFrame, base: StarDims | None = None) -> Conformed:
    """Grow the four dimensions with the members of a cleaned batch, without
    storing them."""
    spark = trips.sparkSession
    base = base or StarDims.empty(spark)
    m = read_members(trips)
    # the three upserts are independent Spark jobs: submit them together,
    # each in a copy of this context (scratch tables stay scoped) and with
    # this thread's Spark job group and pool
    upsert = inheritable_thread_target(spark)(dim_upsert)
    with ThreadPoolExecutor(max_workers=3) as pool:
        def submit(*args):
            return pool.submit(contextvars.copy_context().run, upsert, *args)

        region_f = submit(base.region, m.names["region"], ["description"], m.sizes["region"])
        source_f = submit(base.datasource, m.names["datasource"], ["description"],
                          m.sizes["datasource"])
        coord_f = submit(base.coord, point_members(m.tuples), ["x", "y"])
        region, source, coord = region_f.result(), source_f.result(), coord_f.result()
    n_tuples = m.sizes["tuple"]
    # read by the upsert and by the lookup of the fact: written once
    from triploom.session import materialize

    ids = materialize(tuple_ids(m.tuples, coord.all, n_tuples), "tuple-ids")
    # equal tuples <=> equal coord-id triples, so the triples are distinct
    coord_time = dim_upsert(base.coord_time, ids.select(*CT_KEYS), CT_KEYS, n_tuples)
    return Conformed(
        StarDims(region.all, source.all, coord.all, coord_time.all),
        StarDims(region.new, source.new, coord.new, coord_time.new),
        Numbered(coord_time_map(ids, coord_time.all), n_tuples),
        m.file_counts, m.key_counts, m.total_rows)


def coord_time_map(ids: DataFrame, coord_time: Numbered) -> DataFrame:
    """Tuples with their coord_time id, from tuples with coord ids."""
    ct = lookup(coord_time).withColumnRenamed("id", "coord_time_id")
    return ids.join(ct, CT_KEYS).select(*TUPLE_COLS, "coord_time_id")
