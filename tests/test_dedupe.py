"""Problem 3: one copy of each message."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caseloom.functions.times import moment_micros
from caseloom.operators import dedupe
from caseloom.operators.identity import deliveries, plain_identifier
from caseloom.session import work_path

SCHEMA = "row_id long, message_id string, payload_hl7 string, _payload_sha256 string, received_at string, ingest_date string"
STAMPED = SCHEMA + ", _ingest_ts timestamp"
A, B = "ab" * 32, "cd" * 32


def removed(spark, rows):
    when = lambda i: None if i % 5 == 0 else datetime(2026, 1, 1 + i % 9)
    df = spark.createDataFrame([(i, m, p, None, r, "2026-01-01", when(i)) for i, m, p, r in rows], STAMPED)
    return sorted(r.row_id for r in dedupe.removed_rows(df).collect())


def test_identifier_spellings(spark):
    spelt = [A, A.upper(), "{" + A.upper() + "}", "sha256:" + A, A[:16] + "-" + A[16:], f" {A}  "]
    df = spark.createDataFrame([(s,) for s in spelt], "m string")
    assert {r[0] for r in df.select(plain_identifier(df.m)).collect()} == {A}
    assert removed(spark, [(i, s, f"p{i}", "2026-01-01T00:00:00") for i, s in enumerate(spelt)]) == [1, 2, 3, 4, 5]


def test_moments(spark):
    same = ["2026-03-03T13:08:23+05:30", "2026-03-03T07:38:23Z", "2026-03-03 07:38:23", "2026-03-03T07:38:23.000Z", "1772523503000", " 2026-03-03T02:38:23-0500 "]
    df = spark.createDataFrame([(s,) for s in same], "m string")
    assert {r[0] for r in df.select(moment_micros(df.m)).collect()} == {1772523503000000}
    bad = spark.createDataFrame([(s,) for s in (None, "", "unknown", "2026-13-01T00:00:00", "2026-02-30 00:00:00", "12")], "m string")
    assert {r[0] for r in bad.select(moment_micros(bad.m)).collect()} == {None}


def test_earliest_moment_is_kept_unreadable_last_then_row(spark):
    assert removed(spark, [(1, A, "p", "unknown"), (2, A, "q", "2026-01-02T00:00:00+02:00"), (3, A, "r", "2026-01-01T22:30:00Z")]) == [1, 3]
    assert removed(spark, [(5, A, "p", None), (4, A, "p", "pending")]) == [5]
    assert removed(spark, [(2, A, "p", "2026-01-01T00:00:00Z"), (1, B, "p", "2026-01-01T00:00:00Z")]) == []


def test_missing_identifier_falls_back_to_the_payload(spark):
    rows = [(1, None, "p", "2026-01-02T00:00:00"), (2, "", "p", "2026-01-01T00:00:00"), (3, A, "p", "2026-01-03T00:00:00"), (4, A, "other", "2025-01-01T00:00:00")]
    assert removed(spark, rows) == [1, 2, 3]


def test_neither_identifier_nor_payload_stands_alone(spark):
    assert removed(spark, [(1, None, None, None), (2, " ", " \n", None), (3, None, "\n\n", "x"), (4, None, "\n\n", "x"), (5, A, "\n\n", "x")]) == []


def frame(spark, rows):
    return deliveries(spark.createDataFrame([(i, m, p, None, r, "2026-01-01") for i, m, p, r in rows], SCHEMA))


def kept(store):
    return sorted(r.row_id for r in store.kept().collect())


def test_empty_table_and_repeated_upsert(spark):
    assert removed(spark, []) == []
    rows = frame(spark, [(1, A, "p", "2026-01-02T00:00:00"), (2, A, "p", "2026-01-01T00:00:00"), (3, B, "q", "x")])
    store = dedupe.MessageStore(spark, buckets=3)
    assert kept(store) == []
    store.upsert(rows.where("row_id = 1"))
    store.upsert(rows)
    store.upsert(rows)
    assert kept(store) == [2, 3]
    plan = store.entries().groupBy("key").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(key" not in plan  # equal keys meet in their bucket
    before = sorted(map(str, store._merged().collect()))
    store.compact()
    merged = sorted(map(str, store.entries().collect()))
    store.upsert(rows)
    store.compact()
    assert sorted(map(str, store.entries().collect())) == merged == before and kept(store) == [2, 3]
    assert store.entries().select(F.input_file_name()).distinct().count() <= 3  # one sorted file a bucket


def test_reopening_keeps_what_is_there(spark):
    path = work_path(spark, "test-store")
    first = dedupe.MessageStore(spark, path, buckets=3)
    first.upsert(frame(spark, [(1, A, "p", "2026-01-02T00:00:00"), (5, None, "q", "2026-01-09T00:00:00")]))
    first.close()  # as another session, which does not know the table
    second = dedupe.MessageStore(spark, path, buckets=7)
    second.upsert(frame(spark, [(2, B, "q", "2026-01-03T00:00:00")]))
    assert second.buckets == 3 and kept(second) == [1, 2]
    second.compact()
    third = dedupe.MessageStore(spark, path)
    third.upsert(frame(spark, [(3, A.upper(), "z", "2026-01-01T00:00:00")]))
    third.compact()
    third.close()
    assert kept(dedupe.MessageStore(spark.newSession(), path)) == [2, 3]


def test_a_failed_compaction_changes_nothing(spark, monkeypatch):
    path = work_path(spark, "test-store")
    store = dedupe.MessageStore(spark, path, buckets=2)
    store.upsert(frame(spark, [(1, A, "p", "2026-01-02T00:00:00")]))

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(dedupe, "create_file", broken)  # the files are written, the generation is not named
    with pytest.raises(OSError):
        store.compact()
    monkeypatch.undo()
    store.upsert(frame(spark, [(2, B, "p", "2026-01-02T00:00:00")]))
    assert kept(dedupe.MessageStore(spark, path)) == [1, 2]
    store.compact()
    assert kept(dedupe.MessageStore(spark, path)) == [1, 2]


def test_order_of_first_deliveries(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, -5, 0, 1772523503000000, 253402300799999999]), rng.choice([-(2**63), -1, 0, 7, 2**63 - 1])) for _ in range(60)]
    df = spark.createDataFrame(rows, "m long, r long").select("m", "r", dedupe.first_order(F.col("m"), F.col("r")).alias("o")).withColumn("back", dedupe.row_of(F.col("o")))
    got = df.collect()
    assert all(x.back == x.r for x in got)
    assert [(x.m, x.r) for x in sorted(got, key=lambda x: x.o)] == [(x.m, x.r) for x in sorted(got, key=lambda x: (x.m is None, x.m or 0, x.r))]


def test_against_brute_force(spark):
    rng = random.Random(5)
    ids, payloads, times = [None, "", " ", A, A.upper(), B, "ef" * 32], [None, " ", "p1", "p2", "p3", "p4"], ["x", None, "2026-01-01T00:00:00Z", "2026-01-01T00:00:00+01:00", "1767225600000"]
    rows = [(i, m := rng.choice(ids), {A: "p1", A.upper(): "p2", B: "p3", "ef" * 32: "p4"}.get(m) or rng.choice(payloads), rng.choice(times)) for i in range(200)]
    micros = {"2026-01-01T00:00:00Z": 3_600, "2026-01-01T00:00:00+01:00": 0, "1767225600000": 3_600}
    owner = {"p1": A, "p2": A, "p3": B, "p4": "ef" * 32}
    groups = {}
    for i, m, p, t in rows:
        key = (m or "").strip().lower() or (p or "").strip() or f"row{i}"
        groups.setdefault(owner.get(key, key), []).append((t not in micros, micros.get(t, 0), i))
    want = sorted(x[2] for g in groups.values() for x in sorted(g)[1:])
    assert removed(spark, rows) == want
