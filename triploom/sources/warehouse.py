"""The star tables on storage: one Parquet folder per table under a root.

Every ingest batch writes its new dimension members, fact rows and rejects
into a folder ``batch_id=<n>`` of each table, replacing that folder whole,
also with no rows. ``ingest_log`` holds one row per (batch, source file) and
is written last: it is the commit record. Batch ids are handed out in
order and a failed batch's id is used again, so the committed batches are
exactly those up to the log's largest id, and a read keeps the partitions up
to that one number: no join, and nothing of other partitions is scanned.
:func:`compact` merges the folders of old batches into runs
(:mod:`triploom.sources.runs`); a read then takes the runs, whose rows carry
their batch's id, and the folders after them.
One writer at a time is assumed. ``time_range`` is seeded once,
unpartitioned.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom import schema as S
from triploom.operators.dense_ids import Numbered
from triploom.operators.dims import StarDims
from triploom.operators.time_range import time_range_dim
from triploom.sources import runs as R

BATCHED = ("region", "datasource", "coord", "coord_time", "trip")
GROWING = ("region", "datasource", "coord", "coord_time")

INGEST_LOG = T.StructType([
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("origin", T.StringType(), True),
    T.StructField("origin_batch", T.LongType(), True),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("rows_in", T.LongType(), True),
    T.StructField("rows_rejected", T.LongType(), True),
    *[T.StructField(f"new_{n}s", T.LongType(), True) for n in GROWING],
    # members after the batch: sizes of the dimensions and their largest ids
    *[T.StructField(f"total_{n}s", T.LongType(), True) for n in GROWING],
    T.StructField("committed_at", T.TimestampType(), True),
])

PENDING = T.StructType([T.StructField("batch_id", T.LongType(), False),
                        T.StructField("source_file", T.StringType(), True)])

REJECTS = T.StructType(S.RAW_TRIP.fields + [
    T.StructField("reject_reason", T.StringType(), True),
    T.StructField("raw_line", T.StringType(), True),
])


# Weekly totals that a batch adds; a folder per grain under the batch's.
TRIP_WEEKS = T.StructType([
    T.StructField("region_id", T.LongType(), True),
    T.StructField("coord_time_id", T.LongType(), True),
    T.StructField("iso_year", T.IntegerType(), True),
    T.StructField("week", T.IntegerType(), True),
    T.StructField("num_trips", T.LongType(), True),
    T.StructField("grain", T.StringType(), True),
])


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("batch_id", T.LongType(), True)])


SCHEMAS = {**{n: _with_batch(S.STAR_TABLES[n]) for n in BATCHED},
           "rejects": _with_batch(REJECTS), "trip_weeks": _with_batch(TRIP_WEEKS),
           "ingest_log": INGEST_LOG, "pending": PENDING}

# what a run holds of its batches
MERGED = (*BATCHED, "rejects", "trip_weeks", "ingest_log")


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def batch_path(root: str, name: str, batch_id: int) -> str:
    return os.path.join(root, name, f"batch_id={batch_id}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system it names."""
    fs, hpath = R.file_system(spark, path)
    return fs.exists(hpath)


def _create_empty(spark: SparkSession, path: str) -> None:
    """An empty table is an empty folder; every read passes its schema."""
    fs, hpath = R.file_system(spark, path)
    fs.mkdirs(hpath)


def init_warehouse(spark: SparkSession, root: str) -> dict[str, bool]:
    """Create the tables that do not exist yet; seed ``time_range`` when it
    is created. Returns whether each star table was created."""
    out = {}
    for name in S.STAR_TABLES:
        path = table_path(root, name)
        out[name] = not path_exists(spark, path)
        if out[name] and name == "time_range":
            time_range_dim(spark).coalesce(1).write.parquet(path)
        elif out[name]:
            _create_empty(spark, path)
    for name in ("ingest_log", "rejects", "pending", "trip_weeks"):
        if not path_exists(spark, table_path(root, name)):
            _create_empty(spark, table_path(root, name))
    return out


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows of a table by batch, from runs as far as there are any."""
    read = spark.read.schema(SCHEMAS[name])
    merged = R.current(spark, root)
    df = read.parquet(table_path(root, name))
    if not merged:
        return df
    old = read.parquet(*[os.path.join(r.path, name) for r in merged])
    return old.select(*df.columns).unionByName(
        df.filter(F.col("batch_id") > merged[-1].last))


@dataclass(frozen=True)
class LogHead:
    """The last committed batch (-1: none) and the dimension sizes after it."""

    batch_id: int
    totals: dict[str, int]


def log_head(spark: SparkSession, root: str) -> LogHead:
    totals = [f"total_{n}s" for n in GROWING]
    head = _stored(spark, root, "ingest_log").agg(F.max(F.struct("batch_id", *totals)).alias("h")).first()["h"]
    if head is None:
        return LogHead(-1, dict.fromkeys(GROWING, 0))
    return LogHead(head["batch_id"], {n: head[f"total_{n}s"] or 0 for n in GROWING})


def read_table(spark: SparkSession, root: str, name: str, before_batch: int | None = None,
               committed_only: bool = True, head: LogHead | None = None) -> DataFrame:
    """A star table, with the rows of committed batches; with
    ``before_batch``, only of earlier ones. ``head`` saves reading the log."""
    if name == "time_range":
        return spark.read.schema(S.TIME_RANGE).parquet(table_path(root, name))
    df = _stored(spark, root, name)
    if before_batch is not None:
        df = df.filter(F.col("batch_id") < before_batch)
    if committed_only and name != "ingest_log":
        last = (head or log_head(spark, root)).batch_id
        df = df.filter(F.col("batch_id") <= last)
    return df


def read_dims(spark: SparkSession, root: str, head: LogHead | None = None) -> StarDims:
    """The four growing dimensions with their sizes, which the log holds (ids
    are dense, so a size is the largest id, too)."""
    head = head or log_head(spark, root)
    return StarDims(**{n: Numbered(
        read_table(spark, root, n, head=head).drop("batch_id"), head.totals[n],
        head.totals[n]) for n in GROWING})


def write_batch(df: DataFrame, root: str, name: str, batch_id: int,
                by: tuple[str, ...] = ()) -> None:
    """Replace what a table has of a batch by ``df``, which may be empty;
    ``by`` names columns that become folders below the batch's."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(batch_path(root, name, batch_id))


def read_batch(spark: SparkSession, root: str, name: str, batch_id: int) -> DataFrame:
    """What one batch wrote, committed or not."""
    fields = [f for f in SCHEMAS[name].fields if f.name != "batch_id"]
    return spark.read.schema(T.StructType(fields)).parquet(batch_path(root, name, batch_id))


def clear_batch(spark: SparkSession, root: str, name: str, batch_id: int) -> None:
    """Remove what a table has of a batch."""
    fs, hpath = R.file_system(spark, batch_path(root, name, batch_id))
    fs.delete(hpath, True)


def next_batch_id(spark: SparkSession, root: str) -> int:
    return log_head(spark, root).batch_id + 1


def merged_through(spark: SparkSession, root: str) -> int:
    """The last batch that runs hold (-1: none). Runs are final: no batch up
    to this one can be written again."""
    merged = R.current(spark, root)
    return merged[-1].last if merged else -1


def compact(spark: SparkSession, root: str, target_bytes: int = R.TARGET_BYTES) -> int:
    """Merge the folders of all committed batches but the last, which a replay
    may still replace, into runs of few files. Returns the last merged batch.

    The folders stay until :func:`vacuum`, so readers that have listed them
    can go on. A crash leaves a run that no reader sees. Batches without
    weekly totals must get them before (``plans.ingest.complete_weeks``).
    """
    merged = R.current(spark, root)
    head = log_head(spark, root)
    span = R.next_span(merged, head.batch_id - 1)
    if span is None:
        return merged[-1].last if merged else -1
    lacking = [b for b in range(max(span[0], merged[-1].last + 1 if merged else 0), span[1] + 1)
               if not path_exists(spark, batch_path(root, "trip_weeks", b))]
    if lacking:
        raise ValueError(f"batches {lacking[:5]} have no weekly totals yet")
    path = R.new_path(root, span)
    taken = [r.path for r in merged if r.first >= span[0]]
    for name in MERGED:
        rows = read_table(spark, root, name, before_batch=span[1] + 1, head=head).filter(
            F.col("batch_id") >= span[0])
        folders = [batch_path(root, name, b) for b in range(span[0], span[1] + 1)]
        size = R.files_for(spark, [os.path.join(p, name) for p in taken] + [
            f for f in folders if not taken or int(f.rsplit("=", 1)[1]) > merged[-1].last],
            target_bytes)
        rows = rows.coalesce(size)
        if name == "trip_weeks":   # a column here, no folder: row groups hold one grain
            rows = rows.sortWithinPartitions("grain")
        rows.write.parquet(os.path.join(path, name))
    R.finish(spark, path)
    return span[1]


def vacuum(spark: SparkSession, root: str, older_than: float = R.KEEP_SECONDS) -> int:
    """Remove the folders that runs have replaced ``older_than`` seconds ago,
    and the file lists of their batches. Returns how many folders went."""
    return R.vacuum(spark, root, [(table_path(root, n), "batch_id=")
                                  for n in (*MERGED, "pending")], older_than)
