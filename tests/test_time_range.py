import random

import pytest
from pyspark.sql import functions as F

from triploom.operators.dense_ids import Numbered
from triploom.operators.first_range import NoRangeError, first_range_join, range_blocks
from triploom.operators.skew import lookup_join
from triploom.operators.time_range import range_bucket_join, time_range_dim


def test_seed_table(spark):
    rows = time_range_dim(spark).orderBy("id").collect()
    assert len(rows) == 48
    assert (rows[0].id, rows[0].range, rows[0].time_from, rows[0].time_to) == (1, "0000-0029", 0, 29)
    assert (rows[1].range, rows[-1].id, rows[-1].range) == ("0030-0059", 48, "2330-2359")
    for a, b in zip(rows, rows[1:]):
        # the next range starts one clock minute after the previous one ends
        end = a.time_to + (41 if a.time_to % 100 == 59 else 1)
        assert b.time_from == end


def _minutes(spark):
    m = F.col("id")
    return spark.range(1440).select(
        (F.floor(m / 60) * 100 + m % 60).cast("int").alias("hmm"),
        (F.floor(m / 30) + 1).cast("int").alias("expected"))


def test_range_join_matches_arithmetic(spark):
    got = range_bucket_join(_minutes(spark), "hmm", time_range_dim(spark), out_col="rid")
    assert got.count() == 1440
    assert got.filter(F.col("rid") != F.col("expected")).count() == 0


def test_range_join_without_broadcast(spark, conf):
    conf("triploom.dim.broadcastMaxRows", 0)
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    df = range_bucket_join(_minutes(spark), "hmm", time_range_dim(spark), out_col="rid",
                           bucket_width=7)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert df.filter(F.col("rid") != F.col("expected")).count() == 0
    assert df.count() == 1440


# ------------------------------------------------- first of several ranges ---

RANGES = "id long, time_from long, time_to long, place int"


def _first(spark, values, ranges, **how):
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(values)],
                               "k long, v long, _block string")
    r = spark.createDataFrame(ranges, RANGES)
    return first_range_join(df, "v", r, out_col="rid", **how)


def test_first_match_among_overlapping_ranges(spark):
    ranges = [(1, 40, 60, 2), (2, 45, 70, 1), (3, -9, -3, 0), (4, 100, 90, 0), (5, None, 7, 0),
              (6, 0, 2 ** 61, 9)]
    values = [50, 60, 61, 44, -9, -3, -2, 95, 50]
    by_id = _first(spark, values, ranges, on_missing="null").orderBy("k")
    assert by_id.columns == ["k", "v", "_block", "rid"]
    assert [r["rid"] for r in by_id.collect()] == [1, 1, 2, 1, 3, 3, None, 6, 1]
    by_place = _first(spark, values, ranges, on_missing="null", order=["place"]).orderBy("k")
    assert [r["rid"] for r in by_place.collect()] == [2, 2, 2, 1, 3, 3, None, 6, 2]


def test_a_value_in_no_range_raises(spark):
    with pytest.raises(NoRangeError, match=r"500 \(2 rows\)"):
        _first(spark, [50, 500, 500], [(1, 40, 60, 0)])
    with pytest.raises(NoRangeError):
        _first(spark, [None], [(1, 40, 60, 0)])
    assert _first(spark, [], [(1, 40, 60, 0)]).count() == 0
    assert [r["rid"] for r in _first(spark, [None, 5], [], on_missing="null").collect()] == [
        None, None]
    with pytest.raises(TypeError):
        first_range_join(spark.range(3).selectExpr("id / 2 as v"), "v", time_range_dim(spark))


def test_first_range_matches_brute_force_by_every_path(spark, conf):
    rng = random.Random(4)
    ranges = [(i, a := rng.randrange(-500, 500), a + rng.randrange(0, 400), rng.randrange(5))
              for i in range(200)]
    values = [rng.randrange(-600, 900) for _ in range(3000)] + [7] * 3000
    want = [min(((p, i) for i, a, b, p in ranges if a <= v <= b), default=(0, None))[1]
            for v in values]
    for limit in (1_000_000, 0):   # broadcast; salted joins with hot keys
        conf("triploom.dim.broadcastMaxRows", limit)
        conf("triploom.skew.hotKeyRows", 100)
        got = _first(spark, values, ranges, order=["place"], on_missing="null").orderBy("k")
        assert [r["rid"] for r in got.collect()] == want


def test_lookups_over_the_limit_are_not_broadcast_by_file_size(spark, conf):
    conf("triploom.dim.broadcastMaxRows", 0)     # as if there were over a million rows
    got = _first(spark, list(range(500)), [(i, i, i + 40, i % 7) for i in range(500)],
                 order=["place"])
    assert got.count() == 500
    big = spark.range(500).selectExpr("id % 50 as k", "explode(sequence(1, 12)) as n")
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("rows_in"))
    few = spark.range(50).selectExpr("id as k", "id as v")
    for how in ("left", "inner"):
        met = lookup_join(big, Numbered(few, 50), ["k"], counts, 6000, how)
        assert met.count() == 6000
        for df in (met, got):
            plan = df._jdf.queryExecution().executedPlan().toString()
            joins = [row for row in plan.splitlines() if "_salt#" in row and "Join" in row]
            assert joins and all("SortMergeJoin" in row for row in joins)


def test_blocks_are_few_and_unique_however_ranges_overlap(spark):
    r = spark.range(1000).selectExpr("id", "id as lo", "id + 100000 as hi")
    blocks = range_blocks(r, "lo", "hi", "id", [])
    n, keys = blocks.count(), blocks.select("_size", "_block").distinct().count()
    assert n == keys <= 1000 * 2 * 17
