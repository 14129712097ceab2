from pyspark.sql import functions as F

from conftest import RAW_COLS, pt
from triploom.operators import clean_trips, conform_dims, trip_fact
from triploom.operators.dense_ids import Numbered
from triploom.operators.dims import dim_upsert, name_members

T = "2018-05-28 09:03:40"


def trips(spark, rows):
    return clean_trips(spark.createDataFrame(rows, RAW_COLS))


def test_padded_and_null_region(spark):
    t = trips(spark, [(" Prague\t", pt(1, 2), pt(3, 4), T, "a"),
                      ("Prague", pt(1, 2), pt(3, 4), T, "a"),
                      (None, pt(1, 2), pt(3, 4), T, "a")])
    c = conform_dims(t)
    assert [(r.id, r.description) for r in c.dims.region.df.collect()] == [(1, "Prague")]
    fact = trip_fact(t, c).collect()
    assert sorted((r.region_id is None) for r in fact) == [False, False, True]


def test_repeated_triple_is_one_member(spark):
    t = trips(spark, [("A", pt(1, 2), pt(3, 4), T, "a")] * 2
              + [("A", pt(3, 4), pt(1, 2), T, "a"), ("A", pt(1, 2), pt(1, 2), T, "a")])
    c = conform_dims(t)
    assert c.dims.coord.rows == 2
    assert c.dims.coord_time.rows == 3
    fact = trip_fact(t, c)
    assert fact.count() == 4
    assert fact.groupBy("coord_time_id").count().orderBy(F.desc("count")).first()["count"] == 2


def test_coord_time_ids_follow_key_order(spark):
    t = trips(spark, [("A", pt(5, 5), pt(1, 1), "2018-05-28 23:59:00", "a"),
                      ("A", pt(1, 1), pt(5, 5), "2018-05-28 00:00:00", "a")])
    c = conform_dims(t)
    coords = {(r.x, r.y): r.id for r in c.dims.coord.df.collect()}
    assert coords == {(1.0, 1.0): 1, (5.0, 5.0): 2}
    cts = sorted(tuple(r) for r in c.dims.coord_time.df.collect())
    assert cts == [(1, 1, 2, 1), (2, 2, 1, 48)]


def test_upsert_adds_only_new_members(spark):
    base = spark.createDataFrame([(1, "Prague"), (7, "Turin")], "id int, description string")
    t = trips(spark, [("Turin", pt(1, 2), pt(3, 4), T, "a"),
                      ("Hamburg", pt(1, 2), pt(3, 4), T, "a"),
                      ("  Berlin", pt(1, 2), pt(3, 4), T, "a")])
    up = dim_upsert(Numbered(base, 2), name_members(t, "region"), ["description"])
    assert sorted(tuple(r) for r in up.new.df.collect()) == [(8, "Berlin"), (9, "Hamburg")]
    assert up.all.rows == 4 and up.all.df.count() == 4


def test_two_batches_equal_one_batch(spark):
    rows = [(r, pt(i % 3, i % 2), pt(i % 2, 1), f"2018-05-{1 + i % 28:02d} {i % 24:02d}:00:00", "s")
            for i, r in enumerate(["A", "B", "C", "A"] * 10)]
    t = trips(spark, rows)
    one = conform_dims(t)
    a = conform_dims(t.filter(F.col("datetime") < "2018-05-14"))
    b = conform_dims(t.filter(F.col("datetime") >= "2018-05-14"), base=a.dims)
    assert b.dims.coord_time.rows == one.dims.coord_time.rows
    assert b.dims.coord.rows == one.dims.coord.rows
    # stored ids are never renumbered
    first = {tuple(r[1:]): r[0] for r in a.dims.coord_time.df.collect()}
    after = {tuple(r[1:]): r[0] for r in b.dims.coord_time.df.collect()}
    assert all(after[k] == v for k, v in first.items())
    assert sorted(after.values()) == list(range(1, len(after) + 1))


def test_salted_lookup_equals_broadcast(spark, conf):
    hot = [("A", pt(1, 2), pt(3, 4), f"2018-05-28 09:{m:02d}:00", "s") for m in range(20)]
    nulls = [(None, pt(1, 2), pt(3, 4), T, None)] * 15
    other = [(r, pt(i, 1), pt(1, i), T, "t") for i, r in enumerate("BCDEFG")]
    t = trips(spark, hot + nulls + other).withColumn("k", F.monotonically_increasing_id())
    c = conform_dims(t)
    expected = sorted((tuple(r) for r in trip_fact(t, c, keep=("k",)).collect()), key=repr)
    conf("triploom.dim.broadcastMaxRows", 0)
    conf("triploom.skew.hotKeyRows", 4)
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    c2 = conform_dims(t)
    fact = trip_fact(t, c2, keep=("k",))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    assert sorted((tuple(r) for r in fact.collect()), key=repr) == expected
    assert len(expected) == 41


def test_hot_keys_get_salts_whatever_the_broadcast_limit(spark, conf):
    from triploom.operators.skew import hot_keys

    counts = spark.createDataFrame([("A", 20), ("B", 3), (None, 15)], "region string, rows_in long")
    conf("triploom.dim.broadcastMaxRows", 0)
    conf("triploom.skew.hotKeyRows", 4)
    got = {r.region: r._salts for r in hot_keys(counts, ["region"], 38).collect()}
    assert got == {"A": 5, None: 4}
    # the list is bounded: with at most 2 hot keys, the threshold rises to 19
    conf("triploom.skew.maxHotKeys", 2)
    got = {r.region: r._salts for r in hot_keys(counts, ["region"], 38).collect()}
    assert got == {"A": 2}
