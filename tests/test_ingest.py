import os

import pytest
from pyspark.sql import functions as F

from conftest import RAW_COLS, SF, pt
from triploom.operators.metrics import weekly_avg_by_region_star
from triploom.plans.ingest import ingest, ingest_progress
from triploom.plans.ingest_checks import write_trip_csv
from triploom.sources.csv_trips import read_trips
from triploom.sources.warehouse import init_warehouse, read_dims, read_table
from triploom.streaming.ingest import stream_ingest

T = "2018-05-28 09:03:40"


def metric(spark, root):
    return {r.region: r.weekly_avg_trips for r in weekly_avg_by_region_star(
        read_table(spark, root, "trip"), read_table(spark, root, "region")).collect()}


def test_init_creates_once_and_seeds(spark, workdir):
    root = os.path.join(workdir, "wh")
    first = init_warehouse(spark, root)
    assert all(first.values())
    again = init_warehouse(spark, root)
    assert not any(again.values())
    assert read_table(spark, root, "time_range").count() == 48
    assert read_table(spark, root, "trip").count() == 0


def test_batch_ingest_appends_and_replays(spark, workdir):
    root = os.path.join(workdir, "wh")
    rows = [("A", pt(1, 2), pt(3, 4), T, "s"), ("B", pt(1, 2), pt(5, 6), T, "s")]
    df = spark.createDataFrame(rows, RAW_COLS)
    assert ingest(spark, df, root) == 0
    assert ingest(spark, df, root) == 1          # a batch load appends again
    assert read_table(spark, root, "trip").count() == 4
    dims = read_dims(spark, root)
    assert (dims.region.rows, dims.coord.rows, dims.coord_time.rows) == (2, 3, 2)
    # replaying batch 1 leaves every table as it was
    ingest(spark, df, root, batch_id=1)
    assert read_table(spark, root, "trip").count() == 4
    assert read_dims(spark, root).coord_time.rows == 2
    new = spark.createDataFrame([("C", pt(1, 2), pt(9, 9), T, "s")], RAW_COLS)
    ingest(spark, new, root)
    ids = sorted(r.id for r in read_table(spark, root, "coord").collect())
    assert ids == [1, 2, 3, 4]


def test_quarantine_ingest(spark, workdir):
    root = os.path.join(workdir, "wh")
    rows = [("A", pt(1, 2), pt(3, 4), T, "s"), ("B", "POINT (x y)", pt(5, 6), T, "s")]
    ingest(spark, spark.createDataFrame(rows, RAW_COLS), root, on_error="quarantine")
    assert read_table(spark, root, "trip").count() == 1
    rej = read_table(spark, root, "rejects").collect()
    assert len(rej) == 1 and rej[0].reject_reason == "origin_coord unparseable"
    log = ingest_progress(spark, root).first()
    assert (log.rows_in, log.rows_rejected, log.new_regions) == (2, 1, 1)


def test_fail_mode_writes_nothing(spark, workdir):
    root = os.path.join(workdir, "wh")
    rows = [("A", pt(1, 2), pt(3, 4), T, "s"), ("B", pt(1, 2), pt(5, 6), None, "s")]
    with pytest.raises(Exception):
        ingest(spark, spark.createDataFrame(rows, RAW_COLS), root)
    assert read_table(spark, root, "trip").count() == 0
    assert read_table(spark, root, "region").count() == 0


def test_csv_batch_and_stream_ingest(spark, workdir):
    load1, load2 = write_trip_csv(spark, SF["0.001"], os.path.join(workdir, "files"))
    assert read_trips(spark, [load1, load2]).count() == 1000
    batch_root = os.path.join(workdir, "batch")
    ingest(spark, load1, batch_root)
    ingest(spark, load2, batch_root)
    expected = metric(spark, batch_root)
    assert expected["AFRICA"] == pytest.approx(40.6)

    landing = os.path.join(workdir, "landing")
    root, ckpt = os.path.join(workdir, "stream"), os.path.join(workdir, "ckpt")
    for load in (load1, load2, None, None):
        if load:
            spark.read.option("header", True).csv(load).write.mode("append") \
                .option("header", True).csv(landing)
        q = stream_ingest(spark, landing, root, ckpt)
        q.awaitTermination()
        assert q.exception() is None
    assert metric(spark, root) == expected
    assert read_table(spark, root, "trip").count() == 1000      # each file once
    progress = ingest_progress(spark, root)
    assert progress.agg(F.sum("rows_in")).first()[0] == 1000
    assert progress.select("batch_id").distinct().count() == 2


def test_strict_rejects_other_files(spark, workdir):
    folder = os.path.join(workdir, "mixed")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("region,origin_coord,destination_coord,datetime,datasource\n")
        f.write(f'A,"{pt(1, 2)}","{pt(3, 4)}",{T},s\n')
    with open(os.path.join(folder, "notes.txt"), "w") as f:
        f.write("x")
    assert read_trips(spark, folder).count() == 1
    with pytest.raises(ValueError):
        read_trips(spark, folder, strict=True)


def test_live_weekly_counts_keep_late_trips(spark, workdir):
    from triploom.streaming.weekly_live import current_weekly_counts, start_weekly_counts

    landing, out = os.path.join(workdir, "landing"), os.path.join(workdir, "weekly")

    def run(checkpoint, rows=None):
        if rows:
            spark.createDataFrame(rows, RAW_COLS).write.mode("append") \
                .option("header", True).csv(landing)
        q = start_weekly_counts(spark, landing, out, os.path.join(workdir, checkpoint))
        q.awaitTermination()
        assert q.exception() is None
        return {(r.region, str(r.week_start.date())): r.num_trips
                for r in current_weekly_counts(spark, out).collect()}

    run("ckpt", [("A", pt(1, 2), pt(3, 4), "2024-05-10 23:59:00", "s"),
                 (" A ", pt(1, 2), pt(3, 4), "2024-05-20 10:00:00", "s")])
    # a back-fill two months older
    want = {("A", "2024-05-06"): 1, ("A", "2024-05-20"): 2, ("A", "2024-03-04"): 2}
    assert run("ckpt", [("A", pt(1, 2), pt(3, 4), "2024-03-04 00:00:00", "s"),   # Monday
                        ("A", pt(1, 2), pt(3, 4), "2024-03-10 23:59:59", "s"),   # Sunday
                        ("A", pt(1, 2), pt(3, 4), "2024-05-21 09:00:00", "s")]) == want
    # a new checkpoint counts everything again, and stale epochs don't win
    assert run("other") == want
    assert run("ckpt") == want


def test_stream_epoch_replay_maps_to_same_batch(spark, workdir):
    from triploom.streaming.ingest import _batch_for

    root = os.path.join(workdir, "wh")
    df = spark.createDataFrame([("A", pt(1, 2), pt(3, 4), T, "s")], RAW_COLS)
    init_warehouse(spark, root)
    ingest(spark, df, root)                                   # batch 0, from a batch load
    origin = "stream:/ckpt"
    b = _batch_for(spark, root, origin, 0)
    assert b == 1
    ingest(spark, df, root, batch_id=b, origin=origin, origin_batch=0)
    # the same epoch again (a replay after a failure) maps to batch 1 again
    assert _batch_for(spark, root, origin, 0) == 1
    ingest(spark, df, root, batch_id=1, origin=origin, origin_batch=0)
    assert read_table(spark, root, "trip").count() == 2
    assert _batch_for(spark, root, origin, 1) == 2


def test_ingest_leaves_no_scratch_tables(spark, workdir):
    from triploom.session import ensure_checkpoint_dir

    ckpt = ensure_checkpoint_dir(spark).removeprefix("file:")

    def scratch():
        return sorted(n for n in os.listdir(ckpt) if n.startswith(("batch-members", "dense-ids")))

    before = scratch()
    df = spark.createDataFrame([("A", pt(1, 2), pt(3, 4), T, "s")], RAW_COLS)
    ingest(spark, df, os.path.join(workdir, "wh"))
    assert scratch() == before


def test_landing_progress_and_clean_source(spark, workdir):
    from triploom.plans.ingest import landing_progress
    from triploom.plans.ingest_checks import land_files

    load1, load2 = write_trip_csv(spark, SF["0.001"], os.path.join(workdir, "files"))
    landing, root, ckpt = (os.path.join(workdir, n) for n in ("landing", "wh", "ckpt"))
    archive = os.path.join(workdir, "archive")
    land_files(spark, load1, landing)
    before = landing_progress(spark, landing, root).collect()
    assert before and all(r.percent == 0 for r in before)
    q = stream_ingest(spark, landing, root, ckpt, clean_source="archive", archive_dir=archive)
    q.awaitTermination()
    done = landing_progress(spark, landing, root).collect()
    assert all(r.percent == 100 and r.batch_id == 0 for r in done)
    assert sum(r.rows_in for r in done) == read_table(spark, root, "trip").count()
    land_files(spark, load2, landing)
    q = stream_ingest(spark, landing, root, ckpt, clean_source="archive", archive_dir=archive)
    q.awaitTermination()
    assert read_table(spark, root, "trip").count() == 1000
    # committed files leave the landing folder (the source moves them in a
    # later micro-batch than the one that read them)
    left = {os.path.basename(r.source_file) for r in landing_progress(spark, landing, root).collect()}
    assert not {os.path.basename(r.source_file) for r in done} & left


def test_quarantine_keeps_malformed_lines(spark, workdir):
    folder = os.path.join(workdir, "in")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("region,origin_coord,destination_coord,datetime,datasource\n")
        f.write(f'A,"{pt(1, 2)}","{pt(3, 4)}",{T},s\n')
        f.write('B,"POINT (1 2)"\n')
    root = os.path.join(workdir, "wh")
    with pytest.raises(Exception):
        ingest(spark, folder, os.path.join(workdir, "strict"))
    ingest(spark, folder, root, on_error="quarantine")
    assert read_table(spark, root, "trip").count() == 1
    rej = read_table(spark, root, "rejects").collect()
    assert len(rej) == 1 and rej[0].reject_reason.startswith("malformed line")
    assert rej[0].raw_line == 'B,"POINT (1 2)"'


def test_failed_batch_is_invisible_and_replaced(spark, workdir, monkeypatch):
    import triploom.plans.ingest as I

    root = os.path.join(workdir, "wh")
    first = spark.createDataFrame([("A", pt(1, 2), pt(3, 4), T, "s")], RAW_COLS)
    ingest(spark, first, root)
    real = I.write_batch

    def failing(df, root_, name, batch_id, **kw):
        if name == "trip":
            raise RuntimeError("executor lost while writing the fact")
        return real(df, root_, name, batch_id, **kw)

    second = spark.createDataFrame([("B", pt(5, 6), pt(7, 8), T, "t")], RAW_COLS)
    monkeypatch.setattr(I, "write_batch", failing)
    with pytest.raises(RuntimeError):
        ingest(spark, second, root)
    monkeypatch.setattr(I, "write_batch", real)
    # the half-written batch 1 (its new dimension members) is not visible
    assert read_dims(spark, root).region.rows == 1
    assert read_table(spark, root, "region", committed_only=False).count() == 2
    # the next batch takes id 1 again and replaces the orphan partitions
    assert ingest(spark, second, root) == 1
    dims = read_dims(spark, root)
    assert (dims.region.rows, dims.datasource.rows, dims.coord.rows) == (2, 2, 4)
    assert read_table(spark, root, "region", committed_only=False).count() == 2
    assert read_table(spark, root, "trip").count() == 2


def test_header_must_name_the_columns(spark, workdir):
    folder = os.path.join(workdir, "swapped")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("origin_coord,region,destination_coord,datetime,datasource\n")
        f.write(f'"{pt(1, 2)}",A,"{pt(3, 4)}",{T},s\n')
    with pytest.raises(Exception):
        read_trips(spark, folder).collect()


def test_large_path_ingest_leaves_no_scratch_tables(spark, workdir, conf):
    from triploom.session import ensure_checkpoint_dir

    conf("triploom.denseIds.rowsPerTask", 1)
    ckpt = ensure_checkpoint_dir(spark).removeprefix("file:")

    def scratch():
        return sorted(n for n in os.listdir(ckpt) if n.startswith(("batch-members", "dense-ids")))

    before = scratch()
    rows = [(r, pt(i, 2), pt(3, i), T, "s") for i, r in enumerate("ABCD")]
    root = os.path.join(workdir, "wh")
    ingest(spark, spark.createDataFrame(rows, RAW_COLS), root)
    ingest(spark, spark.createDataFrame(rows[:1] + [("E", pt(9, 9), pt(8, 8), T, "t")],
                                        RAW_COLS), root)
    assert scratch() == before
    assert sorted(r.id for r in read_table(spark, root, "region").collect()) == [1, 2, 3, 4, 5]


def test_progress_counts_each_file_of_a_batch(spark, workdir):
    folder = os.path.join(workdir, "two")
    os.makedirs(folder)
    header = "region,origin_coord,destination_coord,datetime,datasource\n"
    for name, n in (("a.csv", 3), ("b.csv", 2)):
        with open(os.path.join(folder, name), "w") as f:
            f.write(header)
            for i in range(n):
                f.write(f'R{i},"{pt(i, 2)}","{pt(3, i)}",{T},s\n')
    root = os.path.join(workdir, "wh")
    assert ingest(spark, folder, root) == 0
    got = {os.path.basename(r.source_file): (r.batch_id, r.rows_in, r.percent)
           for r in ingest_progress(spark, root).collect()}
    assert got == {"a.csv": (0, 3, 100), "b.csv": (0, 2, 100)}
    log = ingest_progress(spark, root).first()
    assert (log.new_regions, log.new_datasources) == (3, 1)


def _fail_at(monkeypatch, table):
    import triploom.plans.ingest as I

    real = I.write_batch

    def failing(df, root_, name, batch_id, **kw):
        if name == table:
            raise RuntimeError("executor lost")
        return real(df, root_, name, batch_id, **kw)

    monkeypatch.setattr(I, "write_batch", failing)
    return lambda: monkeypatch.setattr(I, "write_batch", real)


@pytest.mark.parametrize("table", ["trip", "ingest_log"])
def test_failed_batch_leaves_nothing_to_a_different_next_one(spark, workdir, monkeypatch, table):
    root = os.path.join(workdir, "wh")
    known = [("A", pt(1, 2), pt(3, 4), T, "s")]
    ingest(spark, spark.createDataFrame(known, RAW_COLS), root)
    bad = spark.createDataFrame([("B", pt(5, 6), pt(7, 8), T, "t"),
                                 ("C", "POINT (x y)", pt(7, 8), T, "t")], RAW_COLS)
    restore = _fail_at(monkeypatch, table)
    with pytest.raises(RuntimeError):
        ingest(spark, bad, root, on_error="quarantine")
    restore()
    # the next load adds no member and no reject
    assert ingest(spark, spark.createDataFrame(known, RAW_COLS), root,
                  on_error="quarantine") == 1
    counts = {n: read_table(spark, root, n).count() for n in (
        "region", "datasource", "coord", "coord_time", "trip", "rejects")}
    assert counts == {"region": 1, "datasource": 1, "coord": 2, "coord_time": 1, "trip": 2,
                      "rejects": 0}
    # and one without any accepted trip replaces the failed one's trips
    restore = _fail_at(monkeypatch, "ingest_log")
    with pytest.raises(RuntimeError):
        ingest(spark, bad, root, on_error="quarantine")
    restore()
    ingest(spark, bad.filter("region = 'C'"), root, on_error="quarantine")
    assert read_table(spark, root, "trip").count() == 2
    assert read_table(spark, root, "rejects").count() == 1
    assert read_table(spark, root, "region").count() == 1


def test_only_the_latest_batch_can_be_rewritten(spark, workdir):
    root = os.path.join(workdir, "wh")
    df = spark.createDataFrame([("A", pt(1, 2), pt(3, 4), T, "s")], RAW_COLS)
    for _ in range(3):
        ingest(spark, df, root)
    for batch in (0, 1, 4):
        with pytest.raises(ValueError):
            ingest(spark, df, root, batch_id=batch)
    assert ingest(spark, df, root, batch_id=2) == 2
    assert read_table(spark, root, "trip").count() == 3


def _land(landing, name, rows, header="region,origin_coord,destination_coord,datetime,datasource"):
    os.makedirs(landing, exist_ok=True)
    with open(os.path.join(landing, f".{name}"), "w") as f:
        f.write(header + "\n" + "".join(f'{r},"{a}","{b}",{t},{s}\n' for r, a, b, t, s in rows))
    os.rename(os.path.join(landing, f".{name}"), os.path.join(landing, name))


def test_stream_identity_is_the_checkpoints(spark, workdir):
    landing, root = os.path.join(workdir, "landing"), os.path.join(workdir, "wh")
    ckpt = os.path.join(workdir, "ckpt")

    def run(path, **options):
        q = stream_ingest(spark, landing, root, path, **options)
        q.awaitTermination()
        assert q.exception() is None

    _land(landing, "a.csv", [("A", pt(1, 2), pt(3, 4), T, "s")])
    run(ckpt)
    _land(landing, "b.csv", [("B", pt(5, 6), pt(7, 8), T, "s")])
    run(ckpt + "/")                      # the same checkpoint, spelled otherwise
    assert read_table(spark, root, "trip").count() == 2
    os.rename(ckpt, ckpt + "-aside")     # a new checkpoint at the old path
    _land(landing, "c.csv", [("B", pt(5, 6), pt(9, 9), T, "s")])
    run(ckpt, max_files_per_trigger=1)
    # it reads all files again, as batches of its own: ids stay unique
    assert read_table(spark, root, "trip").count() == 5
    for name, n in (("region", 2), ("coord", 5), ("coord_time", 3)):
        ids = [r.id for r in read_table(spark, root, name).collect()]
        assert sorted(ids) == list(range(1, n + 1)), name


def test_stream_quarantine_and_empty_files(spark, workdir):
    from triploom.plans.ingest import landing_progress

    landing, root = os.path.join(workdir, "landing"), os.path.join(workdir, "wh")
    _land(landing, "may [1] trips.csv", [("A", pt(1, 2), pt(3, 4), T, "s")])
    _land(landing, "nothing.csv", [])
    with open(os.path.join(landing, "may [1] trips.csv"), "a") as f:
        f.write('B,"POINT (1 2)"\n')
    assert [r.percent for r in landing_progress(spark, landing, root).collect()] == [0, 0]
    q = stream_ingest(spark, landing, root, os.path.join(workdir, "ckpt"),
                      on_error="quarantine")
    q.awaitTermination()
    assert q.exception() is None
    assert read_table(spark, root, "trip").count() == 1
    assert read_table(spark, root, "rejects").count() == 1
    rows = {os.path.basename(r.source_file): (r.rows_in, r.rows_rejected, r.percent)
            for r in landing_progress(spark, landing, root).collect()}
    assert rows == {"may%20%5B1%5D%20trips.csv": (2, 1, 100), "nothing.csv": (0, 0, 100)}
    # a batch of header-only files is committed, too
    _land(landing, "void.csv", [])
    q = stream_ingest(spark, landing, root, os.path.join(workdir, "ckpt"))
    q.awaitTermination()
    assert ingest_progress(spark, root).agg(F.max("batch_id")).first()[0] == 1


def test_progress_of_a_loading_batch(spark, workdir, monkeypatch):
    from triploom.plans.ingest import landing_progress

    landing, root = os.path.join(workdir, "landing"), os.path.join(workdir, "wh")
    _land(landing, "a.csv", [("A", pt(1, 2), pt(3, 4), T, "s")])
    for table, percent in (("region", 10), ("trip", 60), ("ingest_log", 90)):
        restore = _fail_at(monkeypatch, table)
        with pytest.raises(RuntimeError):
            ingest(spark, landing, root)
        restore()
        assert [r.percent for r in landing_progress(spark, landing, root).collect()] == [percent]
    ingest(spark, landing, root)
    assert [r.percent for r in landing_progress(spark, landing, root).collect()] == [100]


def test_strict_ingest_refuses_other_files(spark, workdir):
    landing = os.path.join(workdir, "landing")
    _land(landing, "a.csv", [("A", pt(1, 2), pt(3, 4), T, "s")])
    with open(os.path.join(landing, "notes.txt"), "w") as f:
        f.write("x")
    with pytest.raises(ValueError):
        ingest(spark, landing, os.path.join(workdir, "wh"), strict=True)
    with pytest.raises(ValueError):
        stream_ingest(spark, landing, os.path.join(workdir, "wh2"),
                      os.path.join(workdir, "ckpt"), strict=True)
    assert ingest(spark, landing, os.path.join(workdir, "wh")) == 0


def test_commit_filter_prunes_partitions_without_a_join(spark, workdir, conf):
    root = os.path.join(workdir, "wh")
    df = spark.createDataFrame([("A", pt(1, 2), pt(3, 4), T, "s")], RAW_COLS)
    ingest(spark, df, root)
    ingest(spark, df, root)
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    plan = read_table(spark, root, "trip").select("region_id", "datetime") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_second_batch_runs_few_jobs(spark, workdir):
    root = os.path.join(workdir, "wh")
    ingest(spark, spark.createDataFrame(
        [(f"R{i}", pt(i, 2), pt(3, i), T, "s") for i in range(50)], RAW_COLS), root)
    spark.sparkContext.setJobGroup("second-batch", "second batch")
    try:
        ingest(spark, spark.createDataFrame(
            [(f"R{i}", pt(i, 2), pt(3, i), T, "s") for i in range(40, 60)], RAW_COLS), root)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("second-batch")
    finally:
        spark.sparkContext.setJobGroup("", "")
    print("jobs", len(jobs))
    assert len(jobs) <= 45


def test_a_member_that_occurs_twice_fails_before_the_commit(spark, workdir, monkeypatch):
    import triploom.plans.ingest as I

    root = os.path.join(workdir, "wh")
    df = spark.createDataFrame([("A", pt(1, 2), pt(3, 4), T, "s")], RAW_COLS)
    ingest(spark, df, root)
    real = I._new_members
    monkeypatch.setattr(I, "_new_members", lambda m, *a: real(m.union(m), *a))
    with pytest.raises(ValueError):
        ingest(spark, df.withColumn("region", F.lit("B")), root)
    assert read_table(spark, root, "trip").count() == 1
    assert read_table(spark, root, "region").count() == 1


def test_rollups_equal_the_fact_and_spare_it(spark, workdir):
    from triploom.operators.metrics import weekly_avg_bbox_star
    from triploom.operators.rollup import weekly_avg_bbox_rollup, weekly_avg_by_region_rollup
    from triploom.plans.ingest import complete_weeks
    from triploom.sources.warehouse import clear_batch

    root = os.path.join(workdir, "wh")
    one = [("A", pt(1, 2), pt(3, 4), T, "s"), (None, pt(1, 2), pt(1, 2), T, "s"),
           ("B", pt(7, 7), pt(1, 2), "2021-01-03 10:00:00", "s")] * 3
    two = [("B", pt(1, 2), pt(8, 8), "2018-12-31 10:00:00", "s"), ("A", pt(3, 4), pt(1, 2), T, "s")]
    ingest(spark, spark.createDataFrame(one, RAW_COLS), root)
    ingest(spark, spark.createDataFrame(one[:4], RAW_COLS), root)
    ingest(spark, spark.createDataFrame(two, RAW_COLS), root, batch_id=1)   # replaces
    box = (0, 0, 3, 4)

    def check():
        read = lambda n: read_table(spark, root, n)
        weeks = read("trip_weeks")
        for week in ("week", "iso_year_week"):
            got = weekly_avg_by_region_rollup(weeks, read("region"), week)
            want = weekly_avg_by_region_star(read("trip"), read("region"), week)
            assert got.collect() == want.collect()
            for count in ("endpoints", "trips"):
                args = (read("coord_time"), read("coord"), *box, count, week)
                got = weekly_avg_bbox_rollup(weeks, *args)
                assert got.first() == weekly_avg_bbox_star(read("trip"), *args).first()
                assert got.first()[0] > 0
                plan = got._jdf.queryExecution().executedPlan().toString()
                assert "trip_weeks" in plan and f"{root}/trip," not in plan
                assert "PartitionFilters" in plan and f"{root}/trip]" not in plan

    check()
    clear_batch(spark, root, "trip_weeks", 0)   # as if it was loaded before totals were kept
    assert complete_weeks(spark, root) == [0] and complete_weeks(spark, root) == []
    check()


def test_stream_deletes_what_it_committed_also_after_a_crash(spark, workdir, monkeypatch):
    from triploom.streaming import ingest as streaming

    landing, root, ckpt = (os.path.join(workdir, n) for n in ("landing", "wh", "ckpt"))
    os.makedirs(landing)

    def land(name, region):
        with open(os.path.join(landing, name), "w") as f:
            f.write("region,origin_coord,destination_coord,datetime,datasource\n")
            f.write(f"{region},{pt(1, 2)},{pt(3, 4)},{T},s\n")

    def run():
        q = stream_ingest(spark, landing, root, ckpt, clean_source="delete",
                          max_files_per_trigger=1)
        try:
            q.awaitTermination()
        except Exception as e:   # the failure of the micro-batch
            return str(e)

    land("a 1%.csv", "A")
    land("b.csv", "B")
    run()
    assert os.listdir(landing) == [] and read_table(spark, root, "trip").count() == 2
    land("c.csv", "C")
    land("d.csv", "D")

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(streaming, "remove_loaded", dies)
        assert "lost" in run()
    assert len(os.listdir(landing)) == 2 and read_table(spark, root, "trip").count() == 3
    run()
    assert os.listdir(landing) == [] and read_table(spark, root, "trip").count() == 4
    assert read_table(spark, root, "region").count() == 4


def test_live_boxes_are_limited_and_named(spark, workdir):
    from triploom.streaming import weekly_live

    boxes = {f"b{i}": (0, 0, i, i) for i in range(weekly_live.MAX_BOXES + 1)}
    with pytest.raises(ValueError):
        weekly_live.register_boxes(spark, os.path.join(workdir, "boxes"), boxes)
    few = weekly_live.register_boxes(spark, os.path.join(workdir, "boxes"), {"a": ("2", "", 1, 3)})
    assert [tuple(r) for r in few.collect()] == [("a", 1.0, 2.0, 0.0, 3.0)]
    nothing = weekly_live.current_weekly_bbox(spark, os.path.join(workdir, "none"), few)
    assert [tuple(r) for r in nothing.collect()] == [("a", 0.0)]
    with pytest.raises(ValueError):
        weekly_live.start_weekly_boxes(spark, workdir, few.limit(0), workdir, workdir)


def test_equal_lines_of_a_file_are_spread_over_the_salts(spark, workdir, conf):
    from triploom.operators.skew import row_salt

    folder, root = os.path.join(workdir, "in"), os.path.join(workdir, "wh")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("region,origin_coord,destination_coord,datetime,datasource\n")
        f.write(f"A,{pt(1, 2)},{pt(3, 4)},{T},s\n" * 4000 + f"B,{pt(5, 6)},{pt(3, 4)},{T},s\n")
    rows = read_trips(spark, folder, with_file=True, with_place=True)
    spread = rows.groupBy(row_salt(rows, F.lit(8)).alias("salt")).count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 700
    same = read_trips(spark, folder)
    assert same.filter("region = 'A'").select(row_salt(same, F.lit(8))).distinct().count() == 1
    conf("triploom.dim.broadcastMaxRows", 0)
    conf("triploom.skew.hotKeyRows", 500)
    ingest(spark, folder, root)
    assert read_table(spark, root, "trip").groupBy("region_id").count().collect() and metric(
        spark, root) == {"A": 4000.0, "B": 1.0}
    assert read_table(spark, root, "trip").columns[-1] == "batch_id"


def test_compaction_changes_no_read(spark, workdir, monkeypatch):
    from triploom.operators.rollup import weekly_avg_by_region_rollup
    from triploom.sources import runs as R
    from triploom.sources import warehouse as W

    root = os.path.join(workdir, "wh")

    def load(i, **kw):
        return ingest(spark, spark.createDataFrame(
            [(f"R{i % 3}", pt(i, 2), pt(3, i), T, "s"), (None, pt(1, 2), pt(9, 9), T, f"s{i}"),
             ("R0", "bad", pt(1, 1), T, "s")], RAW_COLS), root, on_error="quarantine", **kw)

    def everything():
        return {n: sorted(map(tuple, read_table(spark, root, n).collect()), key=repr)
                for n in W.MERGED}

    def files(name="trip"):
        return sum(f.endswith(".parquet") for r in R.current(spark, root)
                   for _, _, fs in os.walk(os.path.join(r.path, name)) for f in fs) + sum(
            f.endswith(".parquet") for _, _, fs in os.walk(os.path.join(root, name)) for f in fs)

    assert W.merged_through(spark, root) == -1 and W.vacuum(spark, root) == 0
    load(0)
    assert W.compact(spark, root) == -1          # the only batch may be replayed
    for i in range(1, 4):
        load(i)
    before, open_reader = everything(), read_table(spark, root, "trip")
    with monkeypatch.context() as m:             # dies before the run counts
        m.setattr(R, "finish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            W.compact(spark, root)
    assert W.merged_through(spark, root) == -1 and everything() == before
    assert W.compact(spark, root) == 2 and W.compact(spark, root) == 2
    assert everything() == before
    assert sorted(map(tuple, open_reader.collect()), key=repr) == before["trip"]
    assert W.vacuum(spark, root) == 0            # within the age
    assert W.vacuum(spark, root, older_than=0) > 0
    assert everything() == before and files() <= 8
    assert not os.path.exists(W.batch_path(root, "trip", 2))
    assert len(os.listdir(os.path.join(root, "_runs"))) == 2   # the lost run is gone
    # the last batch can be replaced, merged ones can't, also when they are last again
    load(3, batch_id=3)
    assert {k: len(v) for k, v in everything().items()} == {k: len(v) for k, v in before.items()}
    W.clear_batch(spark, root, "ingest_log", 3)
    with pytest.raises(ValueError):
        load(2, batch_id=2)
    assert load(3) == 3 and everything()["coord"] == before["coord"]
    # later runs take in earlier ones that are no wider
    for i, spans in ((4, ["0-2", "3-3"]), (5, ["0-2", "3-4"]), (6, ["0-2", "3-4", "5-5"])):
        load(i)
        before = everything()
        W.compact(spark, root)
        assert everything() == before
        W.vacuum(spark, root, older_than=0)
        assert everything() == before
        assert [f"{r.first}-{r.last}" for r in sorted(
            R.finished(spark, root), key=lambda r: r.first)] == spans
    assert ingest_progress(spark, root).count() == 7
    weeks, region = read_table(spark, root, "trip_weeks"), read_table(spark, root, "region")
    assert weekly_avg_by_region_rollup(weeks, region).collect() == weekly_avg_by_region_star(
        read_table(spark, root, "trip"), region).collect()


def test_next_span_keeps_few_runs():
    from triploom.sources import runs as R

    runs, most, rewritten = [], 0, 0
    for n in range(300):
        first, last = R.next_span(R.cover(runs), n)
        runs.append(R.Run(first, last, f"{first}-{last}", 0))
        got = R.cover(runs)
        assert got[0].first == 0 and got[-1].last == n
        assert all(b.first == a.last + 1 for a, b in zip(got, got[1:]))
        most, rewritten = max(most, len(got)), rewritten + last - first + 1
    assert most <= 9 and rewritten <= 300 * 9
    assert R.next_span(R.cover(runs), 299) is None
    assert R.cover([R.Run(0, 1, "a", 0), R.Run(3, 4, "b", 0)])[-1].last == 1   # a gap


def test_merged_changelog_gives_the_same_view(spark, workdir):
    from triploom.streaming import weekly_live as L

    landing, out, ckpt = (os.path.join(workdir, n) for n in ("landing", "out", "ckpt"))
    os.makedirs(landing)
    assert L.compact_changes(spark, out) == -1 and L.vacuum_changes(spark, out) == 0
    for i in range(4):
        with open(os.path.join(landing, f"{i}.csv"), "w") as f:
            f.write("region,origin_coord,destination_coord,datetime,datasource\n")
            f.write(f"R{i % 2},{pt(1, 2)},{pt(3, 4)},{T},s\n" * (i + 1))
        q = L.start_weekly_counts(spark, landing, out, ckpt, state_partitions=2)
        q.awaitTermination()
        view = sorted(map(tuple, L.current_weekly_counts(spark, out).collect()))
        L.compact_changes(spark, out)
        assert sorted(map(tuple, L.current_weekly_counts(spark, out).collect())) == view
        L.vacuum_changes(spark, out, older_than=0)
        assert sorted(map(tuple, L.current_weekly_counts(spark, out).collect())) == view
    assert {r[0]: r[2] for r in view} == {"R0": 4, "R1": 6}
    left = [n for n in os.listdir(os.path.join(out, f"query={q.id}")) if n.startswith("epoch=")]
    assert len(left) <= 2
