"""Segment, field and component access for pipe-delimited case messages, as column expressions.

Everything stays in built-in expressions: a segment is taken with one regular expression, so that
no higher-order function interrupts code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.times import strict_date, strict_moment

HEADER = "MSH|^~\\&|"

#: Fields of a whole segment, counted with its name as the first.
FIELD_COUNTS = {"MSH": 12, "PID": 12, "OBR": 8, "OBX": 15, "NTE": 4}

#: Column -> (segment, field, component or None, kind).
FIELD_MAP = {
    "sending_application": ("MSH", 3, None, "text"),
    "facility_id": ("MSH", 4, None, "text"),
    "message_ts": ("MSH", 7, None, "moment"),
    "message_type": ("MSH", 9, None, "text"),
    "message_control_id": ("MSH", 10, None, "text"),
    "hl7_version": ("MSH", 12, None, "text"),
    "patient_key": ("PID", 4, 1, "text"),
    "birth_date": ("PID", 8, None, "date"),
    "sex": ("PID", 9, None, "text"),
    "county": ("PID", 12, 3, "text"),
    "state": ("PID", 12, 4, "text"),
    "postal_code": ("PID", 12, 5, "text"),
    "specimen_collection_date": ("OBR", 8, None, "date"),
    "condition_code": ("OBX", 4, 1, "text"),
    "condition_display": ("OBX", 4, 2, "text"),
    "condition_system": ("OBX", 4, 3, "text"),
    "result_code": ("OBX", 6, 1, "text"),
    "result_display": ("OBX", 6, 2, "text"),
    "abnormal_flag": ("OBX", 9, None, "text"),
    "report_date": ("OBX", 15, None, "date"),
    "clinical_note": ("NTE", 4, None, "text"),
}


def segment(payload: Column, name: str) -> Column:
    """The first segment of a name; segments end at CR, LF or CRLF. NULL if there is none."""
    return F.nullif(F.regexp_extract(payload, rf"(?:^|[\r\n])({name}\|[^\r\n]*)", 1), F.lit(""))


def field(seg: Column, index: int) -> Column:
    """A field by its place in the pipe split, the segment's name being the first."""
    return F.try_element_at(F.split(seg, r"\|", -1), F.lit(index))


def component(fld: Column, index: int) -> Column:
    """A caret-separated component, the first being 1."""
    return F.try_element_at(F.split(fld, r"\^", -1), F.lit(index))


def field_count(seg: Column) -> Column:
    """Fields in a segment, its name included; NULL for a missing one."""
    return F.size(F.split(seg, r"\|", -1)) + F.when(seg.isNull(), F.lit(None).cast("int")).otherwise(F.lit(0))


def absent_as_null(value: Column) -> Column:
    """NULL for a blank value and for the two quotes that mean a deleted one."""
    return F.when(~value.rlike(r"\A(?:\s*|\"\")\z"), value)


def with__raw_fields(df: DataFrame, payload: str = "payload_hl7", blank_as_null: bool = True) -> DataFrame:
    """Adds each mapped field as nullable text (``__raw_<column>``) and each segment (``__seg_<name>``)."""
    out = df.withColumns({f"__seg_{name}": segment(F.col(payload), name) for name in FIELD_COUNTS})

    def raw(name: str) -> Column:
        seg, index, part, _ = FIELD_MAP[name]
        value = field(F.col(f"__seg_{seg}"), index)
        value = component(value, part) if part else value
        return absent_as_null(value) if blank_as_null else value

    return out.withColumns({f"__raw_{name}": raw(name) for name in FIELD_MAP})


def typed(name: str) -> Column:
    """The typed value of a raw field; NULL where the text does not convert."""
    value, kind = F.col(f"__raw_{name}"), FIELD_MAP[name][3]
    return {"text": lambda: value, "date": lambda: strict_date(value), "moment": lambda: strict_moment(value)}[kind]()


def parse_messages(df: DataFrame, payload: str = "payload_hl7", blank_as_null: bool = False) -> DataFrame:
    """Adds the 21 conformed columns to messages. Never raises: what cannot be read is NULL.

    With ``blank_as_null=False`` an empty field stays an empty text, as SURVEY 8-D4 asks by default.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in FIELD_MAP]
    return with__raw_fields(df, payload, blank_as_null).select(*keep, *[typed(name).alias(name) for name in FIELD_MAP])
