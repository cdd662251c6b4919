"""Silver: messages parsed, judged by named rules, split, and retransmissions collapsed by payload hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.hl7 import parse_messages
from caseloom.functions.keys import age_band, age_years
from caseloom.operators.identity import payload_sha256
from caseloom.operators.rejects import error_array

#: The order of the silver columns.
SILVER_COLUMNS = [
    "message_control_id", "message_id", "_payload_sha256", "facility_id", "sending_application", "message_ts", "message_type",
    "hl7_version", "patient_key", "birth_date", "age_years", "age_band", "sex", "county", "state", "postal_code",
    "specimen_collection_date", "condition_code", "condition_display", "condition_system", "result_code", "result_display",
    "abnormal_flag", "is_positive", "clinical_note", "report_date", "report_month", "retransmission_count", "ingest_date",
    "_ingest_ts", "_batch_id",
]


def named_rules(blank_as_null: bool = False):
    """The six rules of the case feed, in their order. An unknown comparison passes."""
    c = F.col
    missing = lambda n: c(n).isNull() | (c(n).rlike(r"\A\s*\z") if blank_as_null else F.lit(False))
    return [
        ("missing_condition_code", missing("condition_code")),
        ("missing_report_date", c("report_date").isNull()),
        ("unparseable_message_ts", c("message_ts").isNull()),
        ("missing_patient_key", missing("patient_key")),
        ("report_date_in_future", c("report_date") > c("ingest_date").try_cast("date")),
        ("negative_age", c("birth_date") > c("report_date")),
    ]


def apply_dq(parsed: DataFrame) -> DataFrame:
    """Adds ``dq_failures``, the names of the rules a message breaks. One generated row each keeps later
    filters from repeating the parse below it."""
    return parsed.select("*", F.inline_outer(F.array(F.struct(error_array(named_rules()).alias("dq_failures")))))


def judged_messages(bronze: DataFrame) -> DataFrame:
    return apply_dq(parse_messages(bronze))


def dedupe_first(df: DataFrame, key: str = "_payload_sha256", order: tuple[str, ...] = ("received_at", "_ingest_ts", "message_id")) -> DataFrame:
    """The first arrival of each payload and how many more there were (``retransmission_count``).

    One aggregation instead of two windows: a task sends one row per payload, so a payload with a
    third of all rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in (key, *order)]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(key).agg(first, (F.count("*") - 1).alias("retransmission_count")).select(key, "_first.*", "retransmission_count")


def silver_cases(clean: DataFrame) -> DataFrame:
    """The 31 silver columns of clean messages, each payload once: by the recorded hash in one spelling, else by the computed one."""
    hashed = clean.withColumn("_payload_sha256", payload_sha256(F.col("payload_hl7"), F.col("_payload_sha256")))
    needed = hashed.drop("dq_failures", "payload_hl7", "source_file", "source_system")
    return (
        dedupe_first(needed)
        .withColumn("age_years", age_years(F.col("birth_date"), F.col("report_date")))
        .withColumns({
            "age_band": age_band(F.col("age_years")),
            "is_positive": F.col("result_code") == "POS",
            "report_month": F.date_format("report_date", "yyyy-MM"),
        })
        .select(*SILVER_COLUMNS)
    )


def rule_histogram(judged: DataFrame) -> DataFrame:
    """Failures per rule, most frequent first."""
    return judged.select(F.explode("dq_failures").alias("rule")).groupBy("rule").agg(F.count("*").alias("failures")).orderBy(F.desc("failures"), "rule")


def balance_sheet(judged: DataFrame) -> DataFrame:
    """bronze = silver + rejected + retransmissions collapsed, in one pass and one distinct count."""
    clean = F.size("dq_failures") == 0
    return judged.agg(
        F.count("*").alias("bronze"),
        F.count_if(~clean).alias("rejected"),
        F.countDistinct(F.when(clean, F.coalesce(payload_sha256(F.col("payload_hl7"), F.col("_payload_sha256")), F.lit("")))).alias("silver"),
    ).withColumn("deduplicated", F.col("bronze") - F.col("rejected") - F.col("silver"))
