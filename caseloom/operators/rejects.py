"""Problem 1: rows that fail to parse.

Every field is loaded as nullable text, cast and constraint rules are evaluated side by side into
an array of reasons, and rows are split by whether that array is empty. All of it is one narrow
projection: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.hl7 import FIELD_COUNTS, FIELD_MAP, HEADER, field_count, typed, with__raw_fields
from caseloom.functions.times import strict_date

#: Fixed values.
SEX_CODES = ("M", "F", "O", "U")
RESULT_CODES = ("POS", "NEG", "IND")


def error_array(rules: list[tuple[str, Column]]) -> Column:
    """The names of the rules whose condition holds, in the rules' order. An unknown condition does not hold."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]))


def split_by_errors(df: DataFrame, errors: str = "dq_failures") -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with an error."""
    return df.where(F.size(errors) == 0), df.where(F.size(errors) > 0)


def message_rules(payload: str = "payload_hl7", ingest_date: str = "ingest_date") -> list[tuple[str, Column]]:
    """The constraint rules of a case message over the columns of :func:`with__raw_fields`."""
    raw = lambda name: F.col(f"__raw_{name}")
    bad_date = lambda name: raw(name).isNotNull() & strict_date(raw(name)).isNull()
    counts = [F.coalesce(field_count(F.col(f"__seg_{s}")) != n, F.lit(False)) for s, n in FIELD_COUNTS.items()]
    wrong_count = counts[0]
    for c in counts[1:]:
        wrong_count = wrong_count | c
    body = F.substring(F.col(payload), len(HEADER) + 1, 2**31 - 1)
    report, birth = typed("report_date"), typed("birth_date")
    return [
        ("wrong_field_count", wrong_count),
        ("broken_escape", F.contains(F.regexp_replace(body, r"\\[FSTRE]\\", ""), F.lit("\\"))),
        ("unparseable_message_ts", typed("message_ts").isNull()),
        ("missing_patient_key", raw("patient_key").isNull()),
        ("missing_condition_code", raw("condition_code").isNull()),
        ("missing_report_date", report.isNull()),
        ("report_date_in_future", report > F.to_date(F.col(ingest_date).try_cast("date"))),
        ("negative_age", birth > report),
        (
            "invalid_value",
            F.coalesce(~raw("sex").isin(*SEX_CODES), F.lit(False))
            | F.coalesce(~raw("result_code").isin(*RESULT_CODES), F.lit(False))
            | bad_date("birth_date")
            | bad_date("specimen_collection_date"),
        ),
    ]


def check_messages(df: DataFrame, payload: str = "payload_hl7", ingest_date: str = "ingest_date") -> DataFrame:
    """Adds ``dq_failures`` and the typed fields to messages; columns of those names are replaced.

    Defined results: a NULL, empty or headerless payload has the one reason ``no_header``; a NULL or
    unreadable ingest date sets no upper bound for the report date; an empty table gives an empty
    result; repeated rows are each judged; very long payloads are read whole.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in FIELD_MAP and c != "dq_failures"]
    no_header = ~F.coalesce(F.startswith(F.col(payload), F.lit(HEADER)), F.lit(False))
    raw = with__raw_fields(df.select(*keep), payload)
    failures = F.when(no_header, F.array(F.lit("no_header"))).otherwise(error_array(message_rules(payload, ingest_date)))
    found = F.struct(failures.alias("dq_failures"), *[typed(name).alias(name) for name in FIELD_MAP])
    # One generated row each: a filter on the result cannot be pushed below a generator, where the
    # optimizer would repeat the whole parse in it, expanded and without shared subexpressions.
    return raw.select(*keep, F.inline_outer(F.array(found)))


def load_messages(df: DataFrame, payload: str = "payload_hl7", ingest_date: str = "ingest_date") -> tuple[DataFrame, DataFrame]:
    """(valid rows with typed fields, rejected rows with their reasons)."""
    return split_by_errors(check_messages(df, payload, ingest_date))


def reason_rows(checked: DataFrame, key: str, table: str) -> DataFrame:
    """One row per faulty row and reason."""
    return checked.select(
        F.lit(table).alias("source_table"), F.col(key).cast("bigint").alias("row_key"), F.explode("dq_failures").alias("reason")
    )
