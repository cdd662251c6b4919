"""Problem 1: reasons, edge cases, plan."""

import pytest
from pyspark.sql import functions as F

from caseloom.operators import rejects

SCHEMA = "row_id long, payload_hl7 string, ingest_date string"


def reasons(spark, *payloads, ingest="2026-03-12"):
    df = spark.createDataFrame([(i, p, ingest) for i, p in enumerate(payloads)], SCHEMA)
    got = rejects.check_messages(df).orderBy("row_id").collect()
    return [list(r.dq_failures) for r in got]


def test_valid_message_with_any_segment_end(spark, message):
    assert reasons(spark, message, message.replace("\r", "\n"), message.replace("\r", "\r\n"), message + "\rZFX|x|y\r") == [[]] * 4


@pytest.mark.parametrize("payload", [None, "", " ", "\n\n", "hello", "msh|^~\\&|x", " MSH|^~\\&|x", "PID|1|"])
def test_no_header_is_the_only_reason(spark, payload):
    assert reasons(spark, payload) == [["no_header"]]


@pytest.mark.parametrize(
    "old, new, want",
    [
        ("|P|2.5.1", "|P", ["wrong_field_count"]),
        ("|P|2.5.1", "|P|2.5.1|", ["wrong_field_count"]),
        (r"\T\ ", r"\T ", ["broken_escape"]),
        (r"\T\ ", r"\X\ ", ["broken_escape"]),
        (r"\T\ ", "\\T|\\ ", ["wrong_field_count", "broken_escape"]),
        ("20260310081500", "20260230081500", ["unparseable_message_ts"]),
        ("20260310081500", "2026031008150", ["unparseable_message_ts"]),
        ("20260310081500", "", ["unparseable_message_ts"]),
        ("20260310081500", "20260310246000", ["unparseable_message_ts"]),
        ("abc123^", '""^', ["missing_patient_key"]),
        ("abc123^", "  ^", ["missing_patient_key"]),
        ("990063002^", "^", ["missing_condition_code"]),
        ("|||F|||20260310", "|||F|||2026031", ["missing_report_date"]),
        ("|||F|||20260310", "|||F|||20260313", ["report_date_in_future"]),
        ("19800229", "20260311", ["negative_age"]),
        ("19800229", "19810229", ["invalid_value"]),
        ("19800229", "", []),
        ("|F|||1 MILL", "|f|||1 MILL", ["invalid_value"]),
        ("|F|||1 MILL", "||||1 MILL", []),
        ("||POS^", "||pos^", ["invalid_value"]),
        ("||20260308", "||yesterday", ["invalid_value"]),
    ],
)
def test_reason(spark, message, old, new, want):
    assert old in message
    assert reasons(spark, message.replace(old, new, 1)) == [want]


def test_missing_segments_and_truncation(spark, message):
    head = message.split("\r")[0]
    cut = message[: message.index("OBX") + 8]
    got = reasons(spark, head, cut)
    assert got[0] == ["missing_patient_key", "missing_condition_code", "missing_report_date"]
    assert got[1] == ["wrong_field_count", "missing_condition_code", "missing_report_date"]


def test_first_segment_of_a_name_counts(spark, message):
    assert reasons(spark, message + "\rPID|2") == [[]]


def test_null_ingest_date_sets_no_bound(spark, message):
    assert reasons(spark, message.replace("|||F|||20260310", "|||F|||20990101"), ingest=None) == [[]]


def test_long_payload_is_read_whole(spark, message):
    assert reasons(spark, message + "x" * 300_000 + "\\", message + "x" * 300_000) == [["broken_escape"], []]


def test_split_keeps_every_row_and_clashing_columns(spark, message):
    df = spark.createDataFrame([(1, message, "2026-03-12"), (1, message, "2026-03-12"), (2, None, None)], SCHEMA)
    df = df.withColumns({"dq_failures": F.lit("old"), "message_ts": F.lit("old"), "reason": F.lit("mine"), "_raw_sex": F.lit("kept"), "a.b": F.lit(1)})
    valid, bad = rejects.load_messages(df)
    assert valid.count() == 2 and bad.count() == 1
    assert str(valid.first().message_ts) == "2026-03-10 08:15:00" and valid.first()["_raw_sex"] == "kept"
    rows = rejects.reason_rows(bad, "row_id", "t").collect()
    assert [(r.source_table, r.row_key, r.reason) for r in rows] == [("t", 2, "no_header")]


def test_empty_table(spark):
    valid, bad = rejects.load_messages(spark.createDataFrame([], SCHEMA))
    assert valid.count() == 0 and bad.count() == 0
