"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder that lineage cuts are written to."""

from __future__ import annotations

import contextvars
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours relies on. AQE re-plans joins from the
# real shuffle sizes (demoting sort-merge to broadcast when a side turns out
# small), coalesces small partitions and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# removes the shuffle files of a query that has ended (Spark 4.1 and later)
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Starting points for a large cluster (hundreds of executors, ~100 TB of
# input). Input splits of 256 MB keep scan tasks in the tens of thousands;
# shuffles start with many partitions and AQE coalesces them towards the
# advisory size, so a partition fits executor memory without tuning per
# query; a shuffle partition over 256 MB and 5x the median is split by the
# skew-join handling; sides AQE measures under 64 MB are broadcast.
CLUSTER_CONF = {
    **{k: v for k, v in SESSION_CONF.items() if not k.startswith("spark.ui")},
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # streaming state (live weekly counts) kept off-heap, not in executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "triploom", conf: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and benches (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The folder comes from the session (``spark.checkpoint.dir``). Only a
    local-mode session without one gets a fresh temporary folder; on a
    cluster a missing setting is an error, because a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for it")
        configured = tempfile.mkdtemp(prefix="triploom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


_SCOPE: contextvars.ContextVar[list | None] = contextvars.ContextVar(
    "triploom_scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables ``materialize`` writes inside the block when it
    ends; only for blocks whose results are fully written before exit."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield paths
    finally:
        _SCOPE.reset(token)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            hpath = jvm.org.apache.hadoop.fs.Path(p)
            hpath.getFileSystem(conf).delete(hpath, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """What the session runs inside the block removes its shuffle files when
    it ends, instead of whenever the driver's garbage collector finds them
    unused. For writes and collects: a DataFrame made inside the block and run
    again would have to shuffle again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back: the lineage is cut, later reuse reads stored rows (not a
    recomputation that could differ), and lost executors cost no rework."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
