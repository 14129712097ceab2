"""Load-once ingest of a landing folder with Structured Streaming.

The stream carries the paths of new files: the file source remembers which
files it has handed out (in the query's checkpoint), so each file is loaded
once, however often the job runs; ``trigger(availableNow=True)`` processes
what has landed and stops. Each micro-batch's files are loaded by
:func:`triploom.plans.ingest.ingest` inside ``foreachBatch``, with the same
reader as a batch load, so malformed lines and files without rows are
treated alike in both.

``foreachBatch`` is at-least-once: a micro-batch that is replayed after a
failure is looked up in the ingest log by the query's id and its epoch, and
replaces that batch. The id is made by Spark for each new checkpoint and
kept in it, so a new checkpoint at an old path, or another spelling of the
same path, can't be mistaken for another query. Only the latest batch can be
replaced; an older one is refused.

``clean_source="delete"`` removes a micro-batch's files as its last step, by
the rows that the batch committed to the ingest log. A run that dies between
the commit and the removal repeats the micro-batch: it is found in the log,
isn't loaded again, and the files that are left go then.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from triploom.plans.ingest import ingest
from triploom.sources.csv_trips import check_only_csv, literal_path, stream_files
from triploom.sources.warehouse import init_warehouse, next_batch_id, read_table

START_SECONDS = 60
FILES_PER_TRIGGER = 1000   # names of one micro-batch pass through the driver


def _batch_for(spark: SparkSession, root: str, origin: str, epoch: int) -> int:
    seen = (read_table(spark, root, "ingest_log")
            .filter((F.col("origin") == origin) & (F.col("origin_batch") == epoch))
            .agg(F.max("batch_id")).first()[0])
    return next_batch_id(spark, root) if seen is None else seen


def remove_loaded(spark: SparkSession, root: str, origin: str, epoch: int) -> int:
    """Delete the files that a stream's micro-batch has committed, by the
    ingest log; files that are gone already don't matter. Returns how many
    went."""
    files = (read_table(spark, root, "ingest_log")
             .filter((F.col("origin") == origin) & (F.col("origin_batch") == epoch)
                     & F.col("source_file").isNotNull()).select("source_file").collect())
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for r in files:
        # the log has the address of a file, with escapes
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["source_file"]))
        gone += bool(path.getFileSystem(conf).delete(path, False))
    return gone


def _committed(spark: SparkSession, root: str, origin: str, epoch: int) -> bool:
    return not (read_table(spark, root, "ingest_log")
                .filter((F.col("origin") == origin) & (F.col("origin_batch") == epoch)).isEmpty())


def stream_ingest(spark: SparkSession, landing: str, root: str, checkpoint: str,
                  on_error: str = "fail", available_now: bool = True,
                  processing_time: str | None = None, clean_source: str = "off",
                  archive_dir: str | None = None,
                  max_files_per_trigger: int = FILES_PER_TRIGGER,
                  name: str | None = None, strict: bool = False) -> StreamingQuery:
    """Start the landing-folder stream; returns the running query.

    ``clean_source="delete"`` removes files in the micro-batch that commits
    them; ``"archive"`` moves them (the file source does this in a later
    micro-batch). At most ``max_files_per_trigger`` files make a micro-batch.
    ``strict`` refuses a landing folder that holds other than CSV files.
    """
    init_warehouse(spark, root)
    if strict:
        check_only_csv(spark, landing)
    query_id: list[str] = []
    started = threading.Event()

    def load(batch: DataFrame, epoch: int) -> None:
        bspark = batch.sparkSession
        if not started.wait(START_SECONDS):
            raise RuntimeError("the query's id is not known")
        if strict:
            check_only_csv(bspark, landing)
        # file names of one micro-batch: bounded by max_files_per_trigger
        paths = [literal_path(r["path"]) for r in batch.collect()]
        if not paths:
            return
        origin = f"stream:{query_id[0]}"
        delete = clean_source == "delete"
        if not (delete and _committed(bspark, root, origin, epoch)):
            ingest(bspark, paths, root, on_error=on_error, origin=origin, origin_batch=epoch,
                   batch_id=_batch_for(bspark, root, origin, epoch))
        if delete:
            remove_loaded(bspark, root, origin, epoch)

    writer = (stream_files(spark, landing,
                           clean_source="off" if clean_source == "delete" else clean_source,
                           archive_dir=archive_dir,
                           max_files_per_trigger=max_files_per_trigger)
              .writeStream.foreachBatch(load)
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    query_id.append(str(query.id))
    started.set()
    return query
