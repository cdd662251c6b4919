"""Problem 6: only what no successful run has taken."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caseloom.operators import incremental
from caseloom.session import path_exists, work_path
from caseloom.sources import landing

M = "row_id long, source_file string, _ingest_ts timestamp, payload string"
L = "source_file string, _batch_id string, _ingest_ts timestamp"
R = "_batch_id string, run_status string"
T = lambda n: datetime(2026, 1, 1, n)


def data(spark):
    m = [
        (1, "file:///l/ingest_date=2026-01-01/a.ndjson", T(1), "x"), (2, "/l/ingest_date%3D2026-01-01/a.ndjson", T(3), "x"), (3, "file:/l//b.ndjson", T(1), "x"), (4, "/l/c.ndjson", T(1), "x"),
        (5, None, T(1), "x"), (6, "/l/./d.ndjson", T(2), "x"), (7, "/l/d.ndjson", None, "x"), (8, "/l/a+b c%20d.ndjson", T(1), "x"),
    ]
    log = [
        ("/l/ingest_date=2026-01-01/a.ndjson", "ok", T(2)), ("/l/b.ndjson", "bad", T(5)), ("/l/c.ndjson", "unlisted", T(5)), ("/l/d.ndjson", "ok2", T(2)), ("/l/d.ndjson", "ok2", T(2)), ("/l/a+b c d.ndjson", "ok", T(1)),
    ]
    runs = [("ok", " Succeeded "), ("ok2", "DONE"), ("bad", "Failed "), ("running", "running"), ("none", None)]
    return spark.createDataFrame(m, M), spark.createDataFrame(log, L), spark.createDataFrame(runs, R)


def test_pending(spark):
    assert sorted(r.row_id for r in incremental.pending_rows(*data(spark)).collect()) == [2, 3, 4, 5, 7]


def test_status_wording(spark):
    words = {"ok": True, "OK": True, "success": True, "Completed": True, "done.": True, "failed": False, "not ok": False, "unsuccessful": False, "completed with errors": False, "running": False, "": False, None: False}
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", incremental.succeeded(F.col("w")).alias("s"))
    assert {r.w: r.s for r in df.collect()} == words


def test_plan_is_replayed_and_the_sink_repeats_nothing(spark):
    m, log, runs = data(spark)
    path, sink = work_path(spark, "test-load"), work_path(spark, "test-sink")
    load = incremental.IncrementalLoad(spark, path)
    plan = load.plan(m, log, runs)
    load.sink(load.take(m, plan).where("row_id < 4"), sink)  # the run dies half way
    later = m.unionByName(spark.createDataFrame([(99, "/l/new.ndjson", T(1), "x")], M))
    again = incremental.IncrementalLoad(spark, path)
    again.sink(again.take(later, again.plan(later, log, runs)), sink)
    again.sink(again.take(later, again.plan(later, log, runs)), sink)
    assert sorted(r.row_id for r in spark.read.parquet(sink).collect()) == [2, 3, 4, 5, 7]


def test_clashing_columns_and_empty_tables(spark):
    m, log, runs = data(spark)
    m = m.withColumns({c: F.lit("mine") for c in ("file", "after", "upto", "offset", "_file", "_salt")})
    load = incremental.IncrementalLoad(spark)
    out = load.take(m, load.plan(m, log, runs))
    assert out.columns == m.columns and out.count() == 5 and out.first().after == "mine"
    assert incremental.pending_rows(m.limit(0), log, runs).count() == 0
    assert incremental.pending_rows(m, log.limit(0), runs).count() == 8
    assert incremental.pending_rows(m, log, runs.limit(0)).count() == 8


STEPS = ["plan written", "plan named", "sink written", "offsets written", "load named"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_killed_between_two_steps_neither_skips_nor_repeats(spark, monkeypatch, step):
    m, log, runs = data(spark)
    path, sink = work_path(spark, "test-load"), work_path(spark, "test-sink")
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")  # nothing may hang on _SUCCESS
    real_file, real_sink, real_commit = incremental.create_file, incremental.IncrementalLoad.sink, incremental.IncrementalLoad.commit

    def die(*_):
        raise KeyboardInterrupt(step)

    def file(spark_, name, *text):
        if (step == "plan written" and "/_plan-" in name) or (step == "offsets written" and "/_done-" in name):
            die()
        real_file(spark_, name, *text)
        if (step == "plan named" and "/_plan-" in name) or (step == "load named" and "/_done-" in name):
            die()

    monkeypatch.setattr(incremental, "create_file", file)
    if step == "sink written":
        monkeypatch.setattr(incremental.IncrementalLoad, "commit", die)
    try:
        with pytest.raises(KeyboardInterrupt):
            incremental.IncrementalLoad(spark, path).run(m, log, runs, sink)
        monkeypatch.undo()
        assert (real_file, real_sink, real_commit) == (incremental.create_file, incremental.IncrementalLoad.sink, incremental.IncrementalLoad.commit)
        # More rows come in before the run is taken up again: a newer one of a known file, and a new file.
        later = m.unionByName(spark.createDataFrame([(99, "/l/new.ndjson", T(1), "x"), (98, "/l/c.ndjson", T(4), "x")], M))
        for _ in range(3):
            load = incremental.IncrementalLoad(spark, path)
            load.run(later, log, runs, sink)
        assert sorted(r.row_id for r in load.sunk(sink).collect()) == [2, 3, 4, 5, 7, 98, 99]
        assert load.number == 4 + (step == "load named") and not path_exists(spark, f"{path}/plan-1")
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_a_hot_file_is_split_and_a_repeated_row_sunk_once(spark):
    m = spark.createDataFrame([(i, "/l/hot.ndjson" if i % 3 else f"/l/{i}.ndjson", T(i % 5), "x") for i in range(300)], M)
    m = m.unionByName(m.where("row_id < 10"))
    _, log, runs = data(spark)
    load, sink = incremental.IncrementalLoad(spark, rows_per_task=20), work_path(spark, "test-sink")
    assert load.run(m, log, runs, sink) == 300 == load.sunk(sink).count()
    assert load.run(m, log, runs, sink) == 0


def test_landing_survives_a_failure_between_bronze_and_log(spark, tmp_path, monkeypatch):
    lake = landing.Lake(str(tmp_path))
    rows = spark.createDataFrame([(f"m{i}", "s", "t", f"p{i}", f"2026-01-0{1 + i % 3}") for i in range(12)], "message_id string, source_system string, received_at string, payload_hl7 string, ingest_date string")
    landing.write_landing(rows, lake.uri("landing", "ecr"))
    monkeypatch.setattr(landing.F, "current_timestamp", lambda: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        landing.land_to_bronze(spark, lake)
    monkeypatch.undo()
    monkeypatch.setattr(incremental.IncrementalLoad, "finish", lambda self: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        landing.land_to_bronze(spark, lake, batch_id="first")
    monkeypatch.undo()
    again = landing.land_to_bronze(spark, lake, batch_id="second")
    bronze = lake.read(spark, "bronze", "ecr_messages")
    assert again["rows"] == 12 == bronze.count() and bronze.select("_batch_id").distinct().count() == 1
    more = spark.createDataFrame([("m99", "s", "t", "p", "2026-01-02")], rows.schema)
    more.write.mode("append").partitionBy("ingest_date").json(lake.uri("landing", "ecr"))
    assert landing.land_to_bronze(spark, lake)["rows"] == 1 and landing.land_to_bronze(spark, lake)["rows"] == 0
    bronze = lake.read(spark, "bronze", "ecr_messages")
    assert bronze.count() == 13 and set(bronze.columns) == set(landing.BRONZE_COLUMNS)
    assert lake.read(spark, "bronze", "_ingest_log").count() == bronze.select("source_file").distinct().count()
