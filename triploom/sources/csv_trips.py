"""Trip files: header CSV with the five raw columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom.schema import RAW_TRIP

CSV_OPTIONS = {
    "header": "true",
    # A header that does not name the expected columns fails the read.
    "enforceSchema": "false",
    "pathGlobFilter": "*.csv",
    "mode": "FAILFAST",
}


CORRUPT = "_corrupt_record"
PLACE = "_place"

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def list_files(spark: SparkSession, path) -> DataFrame:
    """(source_file): the CSV files under ``path``, spelled like the file
    path of :func:`read_trips`. Only the listing is read, not the files."""
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(paths)
            .select(F.col("_metadata.file_path").alias("source_file")).distinct())


def read_trips(spark: SparkSession, path, with_file: bool = False,
               strict: bool = False, keep_malformed: bool = False,
               with_place: bool = False) -> DataFrame:
    """Read every ``*.csv`` under ``path`` (a folder, file or list of them).

    Files are split into ``spark.sql.files.maxPartitionBytes`` pieces and
    read in parallel. ``with_file`` adds the source file path from the
    file metadata. ``strict`` fails when the folder holds non-CSV files.
    A malformed line fails the read, unless ``keep_malformed``: then it is
    kept with its text in ``_corrupt_record`` (for the reject table).
    ``with_place`` adds a number per line, from its piece and its place in the
    piece: a task that is repeated reads the same piece in the same order, so
    every line gets its number again.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if strict:
        check_only_csv(spark, paths)
    reader = spark.read.options(**CSV_OPTIONS)
    if keep_malformed:
        schema = T.StructType(RAW_TRIP.fields + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    else:
        schema = RAW_TRIP
    df = reader.schema(schema).csv(paths)
    if with_file:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    if with_place:
        df = df.withColumn(PLACE, F.monotonically_increasing_id())
    return df


def literal_path(path: str) -> str:
    """``path`` with the characters that a reader takes for patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _stream(reader, clean_source: str, archive_dir: str | None,
            max_files_per_trigger: int | None):
    reader = reader.option("pathGlobFilter", "*.csv").option("cleanSource", clean_source)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader


def stream_files(spark: SparkSession, path: str, clean_source: str = "off",
                 archive_dir: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The paths of new CSV files as an incremental stream, each once, files
    without rows included; the files themselves aren't read.

    ``clean_source``: ``off`` leaves files in place, ``delete`` removes and
    ``archive`` moves them after they have been committed.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    return _stream(reader, clean_source, archive_dir, max_files_per_trigger).load(path).select(
        "path")


def stream_trips(spark: SparkSession, path: str, clean_source: str = "off",
                 archive_dir: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The trips of new CSV files as an incremental stream; each file is read
    once."""
    reader = spark.readStream.schema(RAW_TRIP).options(**CSV_OPTIONS)
    return _stream(reader, clean_source, archive_dir, max_files_per_trigger).csv(
        path).withColumn("source_file", F.col("_metadata.file_path"))


def check_only_csv(spark: SparkSession, paths) -> None:
    """Fail when a folder of ``paths`` (or one of the files) isn't CSV."""
    paths = [paths] if isinstance(paths, str) else paths
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        fs = hpath.getFileSystem(conf)
        if not fs.getFileStatus(hpath).isDirectory():
            names = [p]
        else:
            names = [s.getPath().getName() for s in fs.listStatus(hpath)
                     if s.isFile()]
        bad = [n for n in names if not n.lower().endswith(".csv")
               and not n.startswith((".", "_"))]
        if bad:
            raise ValueError(f"only .csv files can be loaded, found: {bad[:5]}")
