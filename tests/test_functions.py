import datetime as dt

import pytest
from pyspark.sql import functions as F

from triploom.functions import (
    Box, half_hour_bucket, parse_datetime, point_x, point_y, strip_text, time_of_day,
    week_key,
)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_parse_datetime_padded_and_unpadded(spark):
    assert one(spark, parse_datetime("v"), "2018-05-28 09:03:40") == dt.datetime(2018, 5, 28, 9, 3, 40)
    assert one(spark, parse_datetime("v"), "2018-5-28 9:03:40") == dt.datetime(2018, 5, 28, 9, 3, 40)
    assert one(spark, parse_datetime("v"), None) is None


@pytest.mark.parametrize("text,x,y", [
    ("POINT (14.4973794438195 50.00136875782316)", 14.5, 50.0),
    ("POINT (-3.70 40)", -3.7, 40.0),
    ("POINT (7.672837913286881 44.9957109242058)", 7.67, 45.0),
    ("POINT (-0.001 0.004)", 0.0, 0.0),
    ("POINT (a b)", None, None),
    (None, None, None),
])
def test_point_parse(spark, text, x, y):
    assert one(spark, point_x("v"), text) == x
    assert one(spark, point_y("v"), text) == y


def test_negative_zero_is_normalised(spark):
    v = one(spark, point_x("v"), "POINT (-0.001 1)")
    assert v == 0.0 and str(v) == "0.0"


def test_strip_like_python(spark):
    for raw in [" Prague\t", "\n\rPrague\f\v ", "Prague"]:
        assert one(spark, strip_text("v"), raw) == raw.strip()
    assert one(spark, strip_text("v"), "fv") == "fv"  # letters f/v are kept


@pytest.mark.parametrize("ts,bucket,hmm", [
    ("2018-05-01 00:00:00", 1, 0), ("2018-05-01 00:29:59", 1, 29),
    ("2018-05-01 00:30:00", 2, 30), ("2018-05-01 23:59:59", 48, 2359),
    ("2018-05-01 12:45:00", 26, 1245),
])
def test_half_hour_bucket(spark, ts, bucket, hmm):
    c = parse_datetime("v")
    assert one(spark, half_hour_bucket(c), ts) == bucket
    assert one(spark, time_of_day(c), ts) == hmm


def test_week_keys_at_iso_year_edges(spark):
    df = spark.createDataFrame([("2018-12-31 10:00:00",), ("2021-01-01 10:00:00",)], "v string")
    df = df.select(parse_datetime("v").alias("ts"))
    assert [r.week for r in df.select(*week_key("ts")).collect()] == [1, 53]
    rows = df.select(*week_key("ts", "iso_year_week")).collect()
    assert [(r.iso_year, r.week) for r in rows] == [(2019, 1), (2020, 53)]
    with pytest.raises(ValueError):
        week_key("ts", "month")


def test_box_from_corners():
    assert Box.from_corners(2, 3, 1, 0) == Box(1.0, 2.0, 0.0, 3.0)
    assert Box.from_corners("", None, " ", 0) == Box(0.0, 0.0, 0.0, 0.0)
    # numeric comparison, not text comparison
    assert Box.from_corners("10.2", "1", "9.5", "2") == Box(9.5, 10.2, 1.0, 2.0)


def test_box_rejects_non_numeric_corners():
    with pytest.raises(ValueError):
        Box.from_corners("north", 1, 2, 3)
