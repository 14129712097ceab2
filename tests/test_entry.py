import os

import duckdb
import pytest

from conftest import SF

import __spark_entry__ as E

FAST = ["clean_trips", "time_range_assign", "range_bucket_join", "region_dim",
        "coord_time_dim", "dim_upsert", "trip_fact", "weekly_avg_by_region",
        "weekly_avg_by_region_iso_year", "endpoint_points", "weekly_avg_bbox",
        "weekly_avg_bbox_star", "weekly_avg_bbox_star_trips", "coord_time_fanout_audit",
        "by_region_json", "line_point_dim", "weekly_avg_by_region_star", "batch_ingest",
        "compacted_ingest",
        "quarantine_ingest", "ingest_progress", "stream_weekly_counts"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "weekly_avg_trips"]
    assert df.count() == 5


def test_every_trip_query_has_an_oracle():
    from triploom.plans import catalog

    assert set(catalog.queries()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("events", "customer", "nation", "region", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF['0.001'], t)}.parquet'")
    df = E.queries()[name](spark, SF["0.001"])
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    want = [dict(zip(cols, r)) for r in res.fetchall()]
    got = [r.asDict() for r in df.collect()]
    key = sorted(cols)
    assert _norm([tuple(d[k] for k in key) for d in got]) == \
        _norm([tuple(d[k] for k in key) for d in want])
