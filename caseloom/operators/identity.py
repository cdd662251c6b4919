"""Which deliveries are the same message: identifiers in one spelling, and payload hashes.

A delivery with an identifier belongs to that identifier's message. One without belongs to the
message of the deliveries with an identical payload: to their identifier (the smallest, should
several identifiers share that payload), else to the payload itself. One with neither stands alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.times import moment_micros


def plain_identifier(text: Column) -> Column:
    """Lower case, without white space, braces, hyphens and a leading ``algorithm:``; NULL if nothing is left."""
    t = F.regexp_replace(F.lower(text), r"[\s{}\-]", "")
    return F.nullif(F.regexp_replace(t, r"\A(?:sha-?256|urn:sha256|urn:uuid|uuid):", ""), F.lit(""))


def payload_hash(payload: Column, recorded: Column) -> Column:
    """32 bytes: the recorded hash where it is one, else computed; NULL for a payload of white space only.

    A recorded hash is of the payload as delivered (TESTDATA.md), so only missing ones cost a hash.
    """
    given = F.when(recorded.rlike(r"\A[0-9a-fA-F]{64}\z"), F.unhex(recorded))
    blank = F.coalesce(payload.rlike(r"\A\s*\z"), F.lit(True))
    return F.when(~blank, F.coalesce(given, F.unhex(F.sha2(payload, 256))))


def payload_sha256(payload: Column, recorded: Column) -> Column:
    """Hex in lower case: the recorded hash where it is one, else computed; NULL only without payload and hash."""
    given = F.when(recorded.rlike(r"\A[0-9a-fA-F]{64}\z"), F.lower(recorded))
    return F.coalesce(given, F.sha2(payload, 256))


def identifier_bytes(plain: Column) -> Column:
    """Hex identifiers as bytes, half as long in a shuffle; any other text as its own bytes."""
    return F.when(plain.rlike(r"\A(?:[0-9a-f]{2}){8,}\z"), F.unhex(plain)).otherwise(plain.cast("binary"))


def deliveries(df: DataFrame, *keep: str) -> DataFrame:
    """row_id, msg_id, payload_id, moment (µs, NULL if unreadable), ingest_date and ``keep`` of each delivery."""
    return df.select(
        "row_id",
        *keep,
        identifier_bytes(plain_identifier(F.col("message_id"))).alias("msg_id"),
        payload_hash(F.col("payload_hl7"), F.col("_payload_sha256")).alias("payload_id"),
        moment_micros(F.col("received_at")).alias("moment"),
        "ingest_date",
    )


def payload_links(rows: DataFrame) -> DataFrame:
    """payload_id -> link_id, for the payloads of deliveries without identifier that also came with one.

    Map-side combined: one row per payload and task is shuffled, however often a payload occurs.
    """
    return (
        rows.where(F.col("payload_id").isNotNull())
        .groupBy("payload_id")
        .agg(F.min("msg_id").alias("link_id"), F.max(F.col("msg_id").isNull()).alias("wanted"))
        .where("wanted and link_id is not null")
        .select("payload_id", "link_id")
    )


def in_batches(messages: DataFrame, batches: int = 2) -> list[DataFrame]:
    """The deliveries as they came in, parted at quantiles of ``_ingest_ts``; undated ones come first."""
    at = F.unix_micros(F.col("_ingest_ts").cast("timestamp"))
    cuts = messages.agg(F.percentile_approx(at, F.array(*[F.lit(n / batches) for n in range(1, batches)]), F.lit(1000))).first()[0] if batches > 1 else None
    if not cuts:
        return [messages]
    low = [None, *cuts]
    parts = []
    for a, b in zip(low, [*cuts, None]):
        part = F.lit(True) if b is None else at.isNull() | (at <= b) if a is None else at <= b
        parts.append(messages.where(part & (F.lit(True) if a is None else at > a)))
    return parts
