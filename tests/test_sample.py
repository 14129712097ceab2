"""Known results of a 100-row sample file, read in place. Name the file in
TRIPLOOM_SAMPLE_TRIPS to run this; it isn't part of the repository."""

import os

import pytest

from triploom.operators.metrics import weekly_avg_by_region_star
from triploom.plans.ingest import ingest
from triploom.sources.warehouse import read_table

SAMPLE = os.environ.get("TRIPLOOM_SAMPLE_TRIPS")


@pytest.mark.skipif(not SAMPLE, reason="no sample file named")
def test_sample_results(spark, workdir):
    root = os.path.join(workdir, "wh")
    ingest(spark, SAMPLE, root)
    assert read_table(spark, root, "trip").count() == 100
    assert read_table(spark, root, "coord").count() == 182
    got = {r.region: r.weekly_avg_trips for r in weekly_avg_by_region_star(
        read_table(spark, root, "trip"), read_table(spark, root, "region")).collect()}
    assert got == pytest.approx({"Hamburg": 5.6, "Prague": 6.8, "Turin": 7.6})
