"""Streams end when all files are read and go on where they ended."""

from datetime import datetime

from caseloom.session import work_path
from caseloom.streaming import streams

ROWS = "message_id string, ingest_date string"
EVENTS = "ts timestamp, kind string"


def test_ingest_is_exactly_once_per_file(spark):
    base = work_path(spark, "test-stream")
    source = f"{base}/in"
    spark.createDataFrame([(f"m{i}", f"2026-01-0{1 + i % 2}") for i in range(40)], ROWS).write.parquet(source)
    where = {"target": f"{base}/out", "checkpoint": f"{base}/checkpoint"}
    assert streams.ingest_to_bronze(spark, source, **where, runs=2).count() == 40
    spark.createDataFrame([("m99", "2026-01-01")], ROWS).write.mode("append").parquet(source)
    assert streams.ingest_to_bronze(spark, source, **where).count() == 41


def test_daily_counts_are_corrected_by_late_files(spark):
    base = work_path(spark, "test-daily")
    day = lambda d, *kinds: spark.createDataFrame([(datetime(2026, 1, d, 12), k) for k in kinds], EVENTS)
    counts = lambda: {(r.day.day, r.kind): r.n for r in streams.daily_counts(spark, f"{base}/in", "ts", ["kind"], "5 days", f"{base}/state").collect()}
    day(1, "a", "a", None).unionByName(day(3, "a")).write.parquet(f"{base}/in")
    assert counts() == {(1, "a"): 2, (1, None): 1, (3, "a"): 1}
    day(1, "a").write.mode("append").parquet(f"{base}/in")  # late, within the watermark
    assert counts() == {(1, "a"): 3, (1, None): 1, (3, "a"): 1} == counts()
    day(20, "a").write.mode("append").parquet(f"{base}/in")
    counts()
    day(2, "a").write.mode("append").parquet(f"{base}/in")  # beyond the watermark: its day has left the state
    assert counts() == {(1, "a"): 3, (1, None): 1, (3, "a"): 1, (20, "a"): 1}
