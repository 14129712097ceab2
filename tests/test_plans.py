"""Plan properties that matter at scale, checked on the physical plans."""

import pytest

from conftest import SF
import __spark_entry__ as E
from triploom.operators import weekly_avg_bbox, weekly_avg_bbox_star, weekly_avg_by_region_star
from triploom.functions.geo import Box
from triploom.operators.clean import clean_trips
from triploom.operators.metrics import _box_hits
from triploom.plans.ingest import ingest
from triploom.sources.fixture import trips_from_tables
from triploom.sources.warehouse import read_table

FILE_FREE = ["clean_trips", "time_range_assign", "range_bucket_join", "weekly_trip_counts",
             "weekly_avg_by_region", "weekly_avg_by_region_orders",
             "weekly_avg_by_region_iso_year", "weekly_avg_bbox", "weekly_avg_bbox_trips",
             "coord_time_fanout_audit", "by_region_json", "trip_fact", "endpoint_points"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FILE_FREE)
def test_no_python_in_plans(spark, name):
    p = plan(E.queries()[name](spark, SF["0.001"]))
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_coordinates_parsed_once_per_value(spark):
    trips = clean_trips(trips_from_tables(spark, SF["0.001"]))
    p = plan(weekly_avg_bbox(trips, 1.0, 41.0, 2.03, 43.0))
    # four coordinates, one regex each (Catalyst must not inline copies)
    assert p.count("regexp_extract(") <= 4


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "wh")
    ingest(spark, trips_from_tables(spark, SF["0.001"]).drop("trip_key"), root)
    return root


def scans(p: str, table: str) -> list[str]:
    return [x for x in p.splitlines() if "FileScan parquet" in x and f"/{table}]" in x]


def test_box_filter_reaches_coord_scan(spark, warehouse):
    coord_time = read_table(spark, warehouse, "coord_time")
    coord = read_table(spark, warehouse, "coord")
    # the hit list, which the metric writes once: one scan of the members
    box = Box.from_corners(1.0, 41.0, 2.03, 43.0)
    p = plan(_box_hits(coord_time, coord, box, "endpoints"))
    assert len(scans(p, "coord_time")) == 1
    assert scans(p, "coord") and all("GreaterThanOrEqual(x,1.0)" in x for x in scans(p, "coord"))
    q = weekly_avg_bbox_star(read_table(spark, warehouse, "trip"), coord_time, coord,
                             1.0, 41.0, 2.03, 43.0)
    q.collect()
    p = plan(q)
    assert not scans(p, "coord") and not scans(p, "coord_time")
    assert scans(p, "trip") and all(
        "ReadSchema: struct<coord_time_id:bigint,datetime:timestamp_ntz>" in x
        for x in scans(p, "trip"))


def test_region_metric_reads_two_fact_columns(spark, warehouse):
    q = weekly_avg_by_region_star(read_table(spark, warehouse, "trip"),
                                  read_table(spark, warehouse, "region"))
    q.collect()
    trip = [line for line in plan(q).splitlines()
            if "FileScan parquet" in line and "/trip]" in line]
    assert trip and all("ReadSchema: struct<region_id:bigint,datetime:timestamp_ntz>" in line
                        for line in trip)
