import random

import pytest
from pyspark.sql import functions as F

from conftest import RAW_COLS, SF, pt
from triploom.operators import (
    clean_trips, conform_dims, trip_fact, weekly_avg_bbox, weekly_avg_bbox_star,
    weekly_avg_by_region, weekly_avg_by_region_star,
)
from triploom.sources.fixture import trips_from_tables

T = "2018-05-28 09:03:40"


def trips(spark, rows):
    return clean_trips(spark.createDataFrame(rows, RAW_COLS))


def bbox(df, *corners, **kw):
    return df and weekly_avg_bbox(df, *corners, **kw).first()[0]


@pytest.fixture(scope="module")
def fixture_trips(spark):
    df = clean_trips(trips_from_tables(spark, SF["0.001"])).cache()
    yield df
    df.unpersist()


def test_region_goldens(fixture_trips):
    got = {r.region: r.weekly_avg_trips for r in weekly_avg_by_region(fixture_trips).collect()}
    assert got["AFRICA"] == pytest.approx(40.6) and got["EUROPE"] == pytest.approx(28.6)
    rows = weekly_avg_by_region(fixture_trips).collect()
    assert [r.weekly_avg_trips for r in rows] == sorted(r.weekly_avg_trips for r in rows)


def test_box_goldens(fixture_trips):
    assert bbox(fixture_trips, 1.0, 41.0, 2.03, 43.0) == pytest.approx(201.4)
    assert bbox(fixture_trips, 1.0, 41.0, 2.03, 43.0, count="trips") == pytest.approx(156.2)
    assert bbox(fixture_trips, 2.03, 43.0, 1.0, 41.0) == pytest.approx(201.4)
    assert bbox(fixture_trips, "", None, "", None) == 0.0


def test_box_counting_rules(spark):
    t = trips(spark, [("A", pt(1, 1), pt(2, 2), T, "s"),    # both ends in: 2
                      ("A", pt(1, 1), pt(1, 1), T, "s"),    # same point: 1
                      ("A", pt(9, 9), pt(2, 2), T, "s"),    # one end: 1
                      ("A", pt(9, 9), pt(9, 8), T, "s")])   # none: 0
    assert bbox(t, 0, 0, 3, 3) == 4.0
    assert bbox(t, 0, 0, 3, 3, count="trips") == 3.0
    # closed box: a corner on a point counts
    assert bbox(t, 1, 1, 1.0, 1.0) == 2.0
    # empty weeks do not lower the mean
    t2 = t.unionByName(trips(spark, [("A", pt(9, 9), pt(9, 9), "2018-06-11 10:00:00", "s")]))
    assert bbox(t2, 0, 0, 3, 3) == 4.0


def _brute_force(rows, box, count):
    x0, x1, y0, y1 = box
    inside = lambda x, y: x0 <= x <= x1 and y0 <= y <= y1
    per_week = {}
    for r in rows:
        o, d = (r.origin_x, r.origin_y), (r.destination_x, r.destination_y)
        hits = {p for p in (o, d) if inside(*p)}
        n = len(hits) if count == "endpoints" else int(bool(hits))
        if n:
            wk = r.datetime.isocalendar()[1]
            per_week[wk] = per_week.get(wk, 0) + n
    return sum(per_week.values()) / len(per_week) if per_week else 0.0


def test_random_boxes_match_brute_force(fixture_trips):
    rows = fixture_trips.select("origin_x", "origin_y", "destination_x", "destination_y",
                                "datetime").collect()
    rnd = random.Random(7)
    for _ in range(4):
        xa, xb = rnd.uniform(-0.5, 3.5), rnd.uniform(-0.5, 3.5)
        ya, yb = rnd.uniform(40.5, 44), rnd.uniform(40.5, 44)
        box = (min(xa, xb), max(xa, xb), min(ya, yb), max(ya, yb))
        for count in ("endpoints", "trips"):
            assert bbox(fixture_trips, xa, ya, xb, yb, count=count) == pytest.approx(
                _brute_force(rows, box, count))


@pytest.mark.parametrize("broadcast_max", [None, 0])
def test_star_equals_flat(fixture_trips, conf, broadcast_max):
    if broadcast_max is not None:
        conf("triploom.dim.broadcastMaxRows", broadcast_max)
    c = conform_dims(fixture_trips)
    fact = trip_fact(fixture_trips, c)
    flat = sorted(tuple(r) for r in weekly_avg_by_region(fixture_trips).collect())
    star = sorted(tuple(r) for r in weekly_avg_by_region_star(fact, c.dims.region.df).collect())
    assert flat == star
    for count in ("endpoints", "trips"):
        s = weekly_avg_bbox_star(fact, c.dims.coord_time.df, c.dims.coord.df,
                                 1.0, 41.0, 2.03, 43.0, count=count).first()[0]
        assert s == pytest.approx(bbox(fixture_trips, 1.0, 41.0, 2.03, 43.0, count=count))


def test_iso_year_week_keeps_years_apart(spark):
    t = trips(spark, [("A", pt(1, 1), pt(2, 2), "2018-01-03 10:00:00", "s"),
                      ("A", pt(1, 1), pt(2, 2), "2019-01-02 10:00:00", "s")])
    assert weekly_avg_by_region(t).first().weekly_avg_trips == 2.0
    assert weekly_avg_by_region(t, week="iso_year_week").first().weekly_avg_trips == 1.0


def test_fixture_week_count(fixture_trips):
    weeks = fixture_trips.select(F.weekofyear("datetime")).distinct().count()
    assert weeks == 5
