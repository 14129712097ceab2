import datetime as dt

import pytest

from conftest import RAW_COLS, pt
from triploom.operators import clean_trips, split_rejects


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_COLS)


GOOD = (" Prague\t", pt(14.4973794438195, 50.00136875782316),
        pt(14.43109483523328, 50.04052930943246), "2018-05-28 09:03:40", "funny_car")


def test_clean_good_row(spark):
    r = clean_trips(raw(spark, [GOOD])).first()
    assert r.region == "Prague" and r.datasource == "funny_car"
    assert r.datetime == dt.datetime(2018, 5, 28, 9, 3, 40)
    assert r.time_range_id == 19
    assert (r.origin_x, r.origin_y, r.destination_x, r.destination_y) == (14.5, 50.0, 14.43, 50.04)


@pytest.mark.parametrize("bad", [
    ("Prague", "POINT (a b)", pt(1, 2), "2018-05-28 09:03:40", "x"),
    ("Prague", pt(1, 2), pt(1, 2), None, "x"),
    ("Prague", pt(1, 2), None, "2018-05-28 09:03:40", "x"),
    ("Prague", pt(1, 2), pt(1, 2), "yesterday", "x"),
])
def test_fail_mode_raises(spark, bad):
    with pytest.raises(Exception):
        clean_trips(raw(spark, [GOOD, bad])).collect()


def test_quarantine_splits_rows(spark):
    rows = [GOOD,
            ("Turin", "POINT (a b)", pt(1, 2), "2018-05-28 09:03:40", "x"),
            ("Turin", pt(1, 2), pt(1, 2), None, "x"),
            ("Turin", pt(1, 2), pt(1, 2), "2018-5-2 7:3:4", "x")]
    accepted, rejected = split_rejects(clean_trips(raw(spark, rows), on_error="quarantine"))
    assert accepted.count() == 2
    reasons = sorted(r.reject_reason for r in rejected.collect())
    assert reasons == ["datetime missing", "origin_coord unparseable"]
    # the rejected row keeps its text as read
    assert {r.datetime for r in rejected.collect()} == {None, "2018-05-28 09:03:40"}


def test_timestamp_input_passes_through(spark):
    df = spark.createDataFrame(
        [("A", pt(1, 2), pt(3, 4), dt.datetime(2024, 1, 1, 23, 45), "s")],
        "region string, origin_coord string, destination_coord string, "
        "datetime timestamp_ntz, datasource string")
    r = clean_trips(df).first()
    assert r.time_range_id == 48 and r.datetime == dt.datetime(2024, 1, 1, 23, 45)
