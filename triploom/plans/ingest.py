"""Batch ingest: trip files (or any raw-trip frame) into the star tables.

One call is one batch: clean -> member sets -> each dimension's new members,
written and read back -> fact and its weekly totals -> log, the commit. The batch's rows are read
twice (member sets; fact), a third time for the rejects in quarantine mode;
nothing of it is cached. Each stored dimension is scanned once to find the
new members, and what the batch added is read back from its own partition.
Every row-level step runs on the executors; the driver passes batch ids and
scalar counts. Loading the same files twice appends their trips twice, as a
batch load should; use the file stream for load-once semantics.
"""

from __future__ import annotations

import contextvars
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.operators.clean import clean_trips, split_rejects
from triploom.operators.dense_ids import Numbered, dense_ids
from triploom.operators.dims import (
    CT_KEYS, Conformed, StarDims, coord_time_map, lookup, point_members, read_members,
    tuple_ids,
)
from triploom.operators.fact import trip_fact
from triploom.operators.rollup import weekly_rollup
from triploom.schema import DIM_KEYS
from triploom.session import materialize, scratch_scope
from triploom.sources.csv_trips import PLACE, check_only_csv, list_files, read_trips
from triploom.sources.warehouse import (
    GROWING, LogHead, batch_path, clear_batch, init_warehouse, log_head, merged_through,
    path_exists, read_batch, read_dims, read_table, table_path, write_batch,
)

# How far a file is when its batch has come so far (landing_progress).
PERCENT = {"pending": 10, "coord_time": 60, "trip": 90, "ingest_log": 100}


def ingest(spark: SparkSession, source, root: str, on_error: str = "fail",
           batch_id: int | None = None, origin: str = "batch",
           origin_batch: int | None = None, strict: bool = False) -> int:
    """Load one batch; ``source`` is a path (or list) of CSV files or a raw
    trip DataFrame. Returns the batch id written.

    ``batch_id`` may name the last committed batch, which is then replaced,
    or the next one; earlier batches can't be rewritten, because later ones
    hold ids that follow from them. ``strict`` refuses folders with other
    than CSV files.
    """
    init_warehouse(spark, root)
    head = log_head(spark, root)
    files = None
    if isinstance(source, (str, list)):
        if strict:
            check_only_csv(spark, source)
        files = list_files(spark, source)
        raw = read_trips(spark, source, with_file=True, with_place=True,
                         keep_malformed=on_error == "quarantine")
    else:
        raw = source
    if "source_file" not in raw.columns:
        raw = raw.withColumn("source_file", F.lit(None).cast("string"))
    if batch_id is None:
        batch_id = head.batch_id + 1
    if not head.batch_id <= batch_id <= head.batch_id + 1 or batch_id < 0:
        raise ValueError(f"batch {batch_id} can't be written: the last one is {head.batch_id}")
    if batch_id <= merged_through(spark, root):
        raise ValueError(f"batch {batch_id} can't be written: it is merged into a run")
    if batch_id == head.batch_id:
        clear_batch(spark, root, "ingest_log", batch_id)   # takes the commit back
        head = log_head(spark, root)
    with scratch_scope(spark):
        if files is not None:
            write_batch(files, root, "pending", batch_id)
        cleaned = clean_trips(raw, on_error=on_error)
        accepted, rejected = (split_rejects(cleaned) if on_error == "quarantine"
                              else (cleaned, None))
        if rejected is None:
            clear_batch(spark, root, "rejects", batch_id)
        else:
            write_batch(_reject_rows(rejected), root, "rejects", batch_id)
        m = read_members(cleaned)
        conformed = _grow(spark, root, batch_id, head, m)
        place = (PLACE,) if files is not None else ()
        write_batch(trip_fact(accepted, conformed, keep=place).drop(*place), root, "trip",
                    batch_id)
        write_weeks(spark, root, batch_id)
        log = _log_rows(m, conformed, files, origin,
                        batch_id if origin_batch is None else origin_batch)
        write_batch(log, root, "ingest_log", batch_id)
    return batch_id


def write_weeks(spark: SparkSession, root: str, batch_id: int) -> None:
    """A batch's weekly totals, from the trips that it has written."""
    write_batch(weekly_rollup(read_batch(spark, root, "trip", batch_id)), root, "trip_weeks",
                batch_id, by=("grain",))


def complete_weeks(spark: SparkSession, root: str) -> list[int]:
    """Add the weekly totals of committed batches that have none, because they
    were loaded before totals were kept. Returns their ids."""
    init_warehouse(spark, root)
    lacking = [b for b in range(merged_through(spark, root) + 1,
                                log_head(spark, root).batch_id + 1)
               if not path_exists(spark, batch_path(root, "trip_weeks", b))]
    for b in lacking:
        write_weeks(spark, root, b)
    return lacking


def _reject_rows(rejected: DataFrame) -> DataFrame:
    line = (F.col("_corrupt_record") if "_corrupt_record" in rejected.columns
            else F.lit(None).cast("string"))
    return rejected.select("region", "origin_coord", "destination_coord", "datetime",
                           "datasource", "reject_reason", line.alias("raw_line"))


def _new_members(members: DataFrame, stored: Numbered, keys: list[str],
                 at_most: int) -> DataFrame:
    """Members that the stored dimension lacks, numbered after it."""
    if stored.rows:
        members = members.join(lookup(stored).select(*keys), keys, "left_anti")
    return dense_ids(members, keys, at_most, start_after=stored.rows)


def _checked_counts(added: dict[str, DataFrame]) -> dict[str, int]:
    """Rows per dimension that a batch adds, in one job. A key that occurs
    twice would multiply trips in every join, so it fails the batch before
    the commit."""
    rows = [df.select(F.lit(n).alias("name"), F.struct(*DIM_KEYS[n]).cast("string").alias("key"))
            for n, df in added.items()]
    found = reduce(DataFrame.unionAll, rows).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("keys")).collect()
    bad = [r["name"] for r in found if r["n"] != r["keys"]]
    if bad:
        raise ValueError(f"members occur twice in {bad}")
    return {r["name"]: r["n"] for r in found}


def _grow(spark: SparkSession, root: str, batch_id: int, head: LogHead, m) -> Conformed:
    """Write the batch's new members of each dimension and read them back."""
    stored = read_dims(spark, root, head)
    write = inheritable_thread_target(spark)(write_batch)
    n_tuples = m.sizes["tuple"]
    # three independent dimensions: their jobs are submitted together
    # (threads inherit this thread's job group, pool and scratch scope)
    new = {
        "region": lambda: _new_members(m.names["region"], stored.region, ["description"],
                                       m.sizes["region"]),
        "datasource": lambda: _new_members(m.names["datasource"], stored.datasource,
                                           ["description"], m.sizes["datasource"]),
        "coord": lambda: _new_members(point_members(m.tuples), stored.coord, ["x", "y"],
                                      2 * n_tuples)}
    with ThreadPoolExecutor(max_workers=3) as pool:
        jobs = [pool.submit(contextvars.copy_context().run, lambda n=n, f=f: write(
            f(), root, n, batch_id)) for n, f in new.items()]
        for j in jobs:
            j.result()
    added = {n: read_batch(spark, root, n, batch_id) for n in new}
    counts = _checked_counts(added)

    def grown(name: str, n: int) -> Numbered:
        base = getattr(stored, name)
        rows = read_batch(spark, root, name, batch_id)
        if base.rows:
            rows = base.df.unionByName(rows)
        return Numbered(rows, base.rows + n, base.rows + n)

    dims = {n: grown(n, counts.get(n, 0)) for n in new}
    ids = materialize(tuple_ids(m.tuples, dims["coord"], n_tuples), "tuple-ids")
    write_batch(_new_members(ids.select(*CT_KEYS), stored.coord_time, CT_KEYS, n_tuples),
                root, "coord_time", batch_id)
    added["coord_time"] = read_batch(spark, root, "coord_time", batch_id)
    counts |= _checked_counts({"coord_time": added["coord_time"]})
    dims["coord_time"] = grown("coord_time", counts.get("coord_time", 0))
    # read by the fact's join and, above the broadcast limit, by its salting
    ct_map = materialize(coord_time_map(ids, dims["coord_time"]), "coord-time-map")
    return Conformed(StarDims(**dims),
                     StarDims(**{n: Numbered(added[n], counts.get(n, 0)) for n in GROWING}),
                     Numbered(ct_map, n_tuples), m.file_counts, m.key_counts, m.total_rows)


def _log_rows(m, conformed: Conformed, files: DataFrame | None, origin: str,
              origin_batch: int) -> DataFrame:
    """One row per source file, files without rows included; one row without
    a file name when there is no file at all."""
    counts = m.file_counts.select("source_file", "rows_in", "rows_rejected")
    if files is not None:
        counts = files.join(counts, "source_file", "left")
    if not m.total_rows and (files is None or files.isEmpty()):
        # a batch without any file still needs its commit row
        counts = counts.sparkSession.createDataFrame(
            [(None, 0, 0)], "source_file string, rows_in long, rows_rejected long")
    size = lambda dims, n: F.lit(getattr(dims, n).rows).cast("long")
    return counts.select(
        F.lit(origin).alias("origin"),
        F.lit(origin_batch).cast("long").alias("origin_batch"), "source_file",
        F.coalesce("rows_in", F.lit(0).cast("long")).alias("rows_in"),
        F.coalesce("rows_rejected", F.lit(0).cast("long")).alias("rows_rejected"),
        *[size(conformed.added, n).alias(f"new_{n}s") for n in GROWING],
        *[size(conformed.dims, n).alias(f"total_{n}s") for n in GROWING],
        F.current_timestamp().alias("committed_at"))


def ingest_progress(spark: SparkSession, root: str) -> DataFrame:
    """Per source file: the batch that committed it, rows read and rejected,
    and the dimension members its batch added (100 % once listed)."""
    return (read_table(spark, root, "ingest_log")
            .select("batch_id", "origin", "origin_batch", "source_file", "rows_in",
                    "rows_rejected", *[f"new_{n}s" for n in GROWING], "committed_at",
                    F.lit(PERCENT["ingest_log"]).alias("percent"))
            .orderBy("batch_id", "source_file"))


def landing_progress(spark: SparkSession, landing: str, root: str) -> DataFrame:
    """Per CSV file now in the landing folder: 100 % with its batch and row
    counts once committed; how far its batch is while that is loading; 0 %
    while the file waits."""
    none = "source_file string, batch_id long, rows_in long, rows_rejected long"
    files = (list_files(spark, landing) if path_exists(spark, landing)
             else spark.createDataFrame([], "source_file string"))
    log, percent = spark.createDataFrame([], none), F.lit(0)
    loading = spark.createDataFrame([], "source_file string")
    if path_exists(spark, table_path(root, "ingest_log")):
        log = read_table(spark, root, "ingest_log").select(
            "source_file", "batch_id", "rows_in", "rows_rejected")
        now = log_head(spark, root).batch_id + 1
        if path_exists(spark, f"{table_path(root, 'pending')}/batch_id={now}"):
            loading = read_batch(spark, root, "pending", now)
            percent = F.lit(max(p for n, p in PERCENT.items() if path_exists(
                spark, f"{table_path(root, n)}/batch_id={now}/_SUCCESS")
                or n == "pending"))
    return (files.join(log, "source_file", "left")
            .join(loading.withColumn("_loading", F.lit(True)), "source_file", "left")
            .select("source_file", "batch_id", "rows_in", "rows_rejected",
                    F.when(F.col("batch_id").isNotNull(), 100)
                    .when(F.col("_loading"), percent).otherwise(0).alias("percent"))
            .orderBy("source_file"))
