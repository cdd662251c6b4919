"""Instants and dates from text, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MOMENT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?([Zz]|[+-][0-9]{2}:?[0-9]{2})?\z"
HAS_ZONE = r"([Zz]|[+-][0-9]{2}:?[0-9]{2})\z"
EPOCH_MILLIS = r"\A[0-9]{12,13}\z"
MICROS_PER_DAY = 86_400_000_000


def moment_micros(text: Column) -> Column:
    """Microseconds since 1970 UTC of an ISO moment or of epoch milliseconds; NULL if unreadable.

    Text without an offset means UTC. Surrounding white space does not matter.
    """
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    iso = F.replace(F.regexp_replace(t, r"\A(.{10}) ", "$1T"), F.lit(","), F.lit("."))
    iso = F.upper(F.regexp_replace(iso, r"([+-][0-9]{2})([0-9]{2})\z", "$1:$2"))
    zoned = F.when(iso.rlike(HAS_ZONE), iso).otherwise(F.concat(iso, F.lit("Z")))
    return F.when(t.rlike(ISO_MOMENT), F.unix_micros(zoned.try_cast("timestamp"))).when(
        t.rlike(EPOCH_MILLIS), t.try_cast("bigint") * 1000
    )


def utc_day(micros: Column) -> Column:
    """The UTC day of microseconds since 1970."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / F.lit(MICROS_PER_DAY)).cast("int"))


def strict_date(text: Column) -> Column:
    """The date of exactly eight digits that name a real day, else NULL."""
    return F.when(text.rlike(r"\A[0-9]{8}\z"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))


def strict_moment(text: Column) -> Column:
    """The moment of exactly fourteen digits that name a real second, else NULL."""
    return F.when(text.rlike(r"\A[0-9]{14}\z"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))
