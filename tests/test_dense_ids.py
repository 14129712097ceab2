import pytest
from pyspark.sql import functions as F

from triploom.operators.dense_ids import assign_dense_ids


def _keys(spark, n=5000):
    return spark.range(n).select(((F.col("id") * 7919) % n).alias("k"),
                                 (F.col("id") % 3).alias("g")).distinct()


def _check(numbered, start, n):
    rows = sorted((r.id, r.k, r.g) for r in numbered.df.collect())
    assert numbered.rows == n == len(rows)
    assert [r[0] for r in rows] == list(range(start + 1, start + n + 1))
    keys = [(r[1], r[2]) for r in rows]
    assert keys == sorted(keys)


def test_one_range(spark):
    _check(assign_dense_ids(_keys(spark), ["k", "g"], start_after=10), 10, 5000)


def test_range_partition_path(spark, conf):
    conf("triploom.denseIds.rowsPerTask", 100)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    _check(assign_dense_ids(_keys(spark), ["k", "g"], start_after=3), 3, 5000)


def test_empty(spark, conf):
    empty = _keys(spark).limit(0)
    assert assign_dense_ids(empty, ["k", "g"]).rows == 0
    conf("triploom.denseIds.rowsPerTask", 100)
    assert assign_dense_ids(empty, ["k", "g"]).df.count() == 0


def test_range_partition_path_with_coalescing(spark, conf):
    conf("triploom.denseIds.rowsPerTask", 100)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf("spark.sql.shuffle.partitions", 64)
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", 2048)
    _check(assign_dense_ids(_keys(spark, 20000), ["k", "g"], start_after=100), 100, 20000)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("each", [100, 10_000])
def test_ids_past_the_int_range(spark, conf, ansi, each):
    conf("spark.sql.ansi.enabled", ansi)
    conf("triploom.denseIds.rowsPerTask", each)
    _check(assign_dense_ids(_keys(spark), ["k", "g"], start_after=2**31 - 9), 2**31 - 9, 5000)


def test_no_window_over_all_keys(spark, conf):
    for each in (100, 10_000):
        conf("triploom.denseIds.rowsPerTask", each)
        plan = assign_dense_ids(_keys(spark), ["k", "g"]).df._jdf.queryExecution().toString()
        assert "Window" not in plan
