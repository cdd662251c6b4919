"""Problem 4: counts by event time that late cases correct."""

import random
import uuid
from datetime import date, datetime

import pytest

from caseloom.operators import late
from caseloom.session import clear_work, shared_dir
from caseloom.streaming import streams

CASES = "message_control_id string, message_id string, facility_id string, report_date date"
MESSAGES = "row_id long, message_id string, payload_hl7 string, _payload_sha256 string, received_at string, ingest_date string"
IDS = [f"{i:064x}" for i in range(16, 30)]


def frames(spark, cases, messages):
    return spark.createDataFrame(cases, CASES), spark.createDataFrame(messages, MESSAGES)


def test_cutoff_and_arrival(spark):
    d = date(2026, 3, 1)
    cases = [("on", IDS[0], "F", d), ("one", IDS[1], "F", d), ("ten", IDS[2], "F", d), ("eleven", IDS[3], "F", d), ("early", IDS[4], "F", d), ("unknown", IDS[5], None, d), ("nodate", IDS[6], "F", None), ("one", IDS[1], "F", d)]
    messages = [
        (1, IDS[0], "a", None, "2026-03-01T23:59:59Z", "2026-03-20"),
        (2, IDS[1].upper(), "b", None, "2026-03-02T00:30:00Z", "2026-03-02"), (3, IDS[1], "b", None, "2026-03-20T00:00:00Z", "2026-03-20"),
        (4, IDS[2], "c", None, "unknown", "2026-03-12"), (5, IDS[2], "c2", None, None, "2026-03-11"),
        (6, IDS[3], "e", None, "2026-03-13T00:30:00+01:00", "2026-03-13"), (7, IDS[3], "e", None, "pending", "2026-03-01"),
        (8, IDS[4], "f", None, "2026-02-20T00:00:00Z", "2026-03-20"),
        (9, None, "c", None, "2026-03-30T00:00:00Z", "2026-03-30"),
    ]
    state = late.case_slots(*frames(spark, cases, messages))
    got = {(r.message_control_id, r.outcome) for r in late.late_cases(state).collect()}
    # The nameless copy of "c" is the same message and has its only readable moment.
    assert got == {("one", "corrects"), ("ten", "too_late"), ("eleven", "too_late")}
    row = late.period_counts(state).first()
    assert (row.on_time, row.corrections, row.corrected_count, row.too_late) == (3, 1, 4, 2)


V = late.version_of


def state(spark, *rows):
    df = spark.createDataFrame([(date(2026, 1, p), f, m, date(2026, 1, d) if d else None, r) for p, f, m, d, r in rows], "period date, source string, sequence string, day date, readable boolean")
    return df.select("period", "source", "sequence", V(df.day, df.readable).alias("version"))


def seen(df):
    return {r.sequence: r.a for r in df.select("sequence", late.arrival_of(df.version).alias("a")).collect()}


def same(*frames_):
    return len({str(sorted(map(str, df.collect()))) for df in frames_}) == 1


def test_merge_is_idempotent_commutative_and_keeps_the_earliest(spark):
    a = state(spark, (1, "F", "m1", 5, True), (1, None, "m2", None, True), (1, "F", "m4", 2, False))
    b = state(spark, (1, "F", "m1", 3, True), (2, "F", "m3", 2, True), (1, "F", "m4", 9, True), (1, "F", "m1", 1, False))
    ab = late.merge_slots(a, b)
    assert same(ab, late.merge_slots(b, a), late.merge_slots(a, b, a, b, b), late.merge_slots(ab, ab), late.merge_slots(late.merge_slots(b, b), a))
    # A readable reception outranks any ingest date; of its kind the earlier one.
    assert seen(ab) == {"m1": date(2026, 1, 3), "m2": None, "m3": date(2026, 1, 2), "m4": date(2026, 1, 9)}


def test_counters_merge_by_the_greatest_version(spark):
    a = late.source_counters(state(spark, (1, "F", "m1", 1, True), (1, "G", "m2", 3, True)), 1)
    b = late.source_counters(state(spark, (1, "F", "m1", 1, True), (1, "F", "m3", 20, True), (2, "F", "m4", None, True)), 2)
    ab = late.merge_counters(a, b)
    assert same(ab, late.merge_counters(b, a), late.merge_counters(a, a, b, ab))
    assert {(r.source, r.period.day): (r.version, r.on_time, r.corrects, r.too_late) for r in ab.collect()} == {("F", 1): (2, 1, 0, 1), ("G", 1): (1, 0, 1, 0), ("F", 2): (2, 1, 0, 0)}


def counts(store):
    return {r.period.day: (r.on_time, r.corrections, r.corrected_count, r.too_late) for r in store.counts().collect()}


def test_stored_state_is_corrected_by_late_batches_and_survives(spark, monkeypatch):
    path = f"{shared_dir(spark)}/own-{uuid.uuid4().hex}"
    one = state(spark, (1, "F", "m1", 1, True), (1, "G", "m2", 4, True), (2, "F", "m5", 2, True))
    two = state(spark, (1, "F", "m3", 20, True), (1, "G", "m2", 1, True))
    late.CounterStore(spark, path).merge(one)
    assert counts(late.CounterStore(spark, path)) == {1: (1, 1, 2, 0), 2: (1, 0, 1, 0)}
    clear_work(spark)  # the state is not in the work folder
    late.CounterStore(spark, path).merge(two)
    want = {1: (2, 0, 2, 1), 2: (1, 0, 1, 0)}
    assert counts(late.CounterStore(spark, path)) == want
    late.CounterStore(spark, path).merge(one)  # a retry of an old batch
    assert counts(late.CounterStore(spark, path)) == want

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(late, "create_file", broken)  # everything is written but the manifest
    with pytest.raises(OSError):
        late.CounterStore(spark, path).merge(state(spark, (1, "F", "m9", 1, True)))
    monkeypatch.undo()
    assert counts(late.CounterStore(spark, path)) == want
    late.CounterStore(spark, path).merge(state(spark, (3, "F", "m9", 3, True)))
    assert counts(late.CounterStore(spark, path)) == want | {3: (1, 0, 1, 0)}


def test_closed_periods_keep_their_counts_and_lose_their_slots(spark):
    store = late.CounterStore(spark, cutoff_days=10)
    store.merge(state(spark, (1, "F", "m1", 1, True), (9, "F", "m2", 9, True)))
    store.evict("2026-01-15")
    assert {r.sequence for r in store.slots().collect()} == {"m2"}
    store.merge(state(spark, (1, "F", "m7", 16, True), (9, "F", "m3", 12, True)))
    assert counts(store) == {1: (1, 0, 1, 0), 9: (1, 1, 2, 0)} and seen(store.set_apart()) == {"m7": date(2026, 1, 16)}
    assert counts(store) == {r.period.day: (r.on_time, r.corrections, r.corrected_count, r.too_late) for r in streams.merge_state(spark, state(spark, (1, "F", "m7", 16, True)), store.path, "2026-01-15").collect()}


def test_batches_give_what_the_whole_gives(spark):
    rng = random.Random(4)
    d = date(2026, 3, 1)
    cases = [(f"c{i}", IDS[i], f"F{i % 3}", d) for i in range(len(IDS))]
    messages = [
        (n, rng.choice([IDS[i], IDS[i].upper(), None]), f"p{i}", None, rng.choice([None, f"2026-03-{rng.randint(1, 28):02d}T00:00:00Z"]), f"2026-03-{rng.randint(1, 28):02d}", datetime(2026, 3, rng.randint(1, 28)))
        for n in range(120) for i in [rng.randrange(len(IDS))]
    ] + [(1000 + i, IDS[i], f"p{i}", None, None, "2026-03-30", datetime(2026, 3, 30)) for i in range(len(IDS))]
    c, m = spark.createDataFrame(cases, CASES), spark.createDataFrame(messages, MESSAGES + ", _ingest_ts timestamp")
    store = late.merged_batches(c, m, batches=3)
    assert same(store.slots(), late.case_slots(c, m)) and same(store.counts(), late.period_counts(late.case_slots(c, m)))


def test_empty(spark):
    state = late.case_slots(*frames(spark, [], []))
    assert state.count() == 0 and late.period_counts(state).count() == 0 and late.late_cases(state).count() == 0


def test_extra_columns_do_not_matter(spark):
    c, m = frames(spark, [("x", IDS[0], "F", date(2026, 1, 1))], [(1, IDS[0], "a", None, "2026-01-03T00:00:00Z", "2026-01-03")])
    from pyspark.sql import functions as F

    c, m = c.withColumns({"period": F.lit(1), "version": F.lit(2), "moment": F.lit(3)}), m.withColumns({"moment": F.lit("x"), "msg_id": F.lit("y"), "arrived": F.lit(datetime(2026, 1, 1))})
    assert [tuple(r) for r in late.late_cases(late.case_slots(c, m)).collect()] == [("x", "corrects")]
