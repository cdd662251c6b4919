"""Problem 4: late and out-of-order events, counted with conflict-free counters.

A source (facility) counts, for each period, the messages of its own sequence. A slot is keyed by period,
source and sequence and carries a version, the rank of what is known of the message's arrival: an earlier
arrival ranks higher. Merging takes the greatest version of each slot; a source's counter of a period is
the sum over its slots, with the number of the merge it was made in as its own version, and of two states of a
counter the one with the greater version holds. Both merges are commutative, associative and idempotent,
so batches may be repeated, reordered or come from several writers. A period's count is the sum over its
sources of what arrived within the cut-off, so a late record corrects the period it belongs to.
"""

from __future__ import annotations

import json
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.times import utc_day
from caseloom.operators.identity import deliveries, identifier_bytes, in_batches, payload_links, plain_identifier
from caseloom.session import child_names, create_file, delete_path, read_file, stored, work_path

SLOT = ["period", "source", "sequence"]
COUNTS = ["on_time", "corrects", "too_late"]

_READ = 2**40
_EPOCH = "1970-01-01"


def version_of(day: Column, readable: Column) -> Column:
    """The rank of an arrival: readable receptions above all others, earlier days above later ones; NULL without a day."""
    d = F.datediff(day, F.lit(_EPOCH).cast("date")).cast("bigint")
    return F.when(readable, F.lit(_READ) - d).otherwise(-d)


def arrival_of(version: Column) -> Column:
    """The day of a :func:`version_of`."""
    d = F.when(version > _READ // 2, F.lit(_READ) - version).otherwise(-version)
    return F.date_add(F.lit(_EPOCH).cast("date"), d.cast("int"))


def merge_slots(*states: DataFrame) -> DataFrame:
    """The least upper bound of states: the greatest version of each slot. An unknown arrival (NULL) loses."""
    merged = states[0]
    for s in states[1:]:
        merged = merged.unionByName(s)
    return merged.groupBy(*SLOT).agg(F.max("version").alias("version"))


def merge_counters(*states: DataFrame) -> DataFrame:
    """Per period and source the counter with the greatest version (of equal versions, which are one counter, any)."""
    merged = states[0]
    for s in states[1:]:
        merged = merged.unionByName(s)
    return merged.groupBy("period", "source").agg(F.max(F.struct("version", *COUNTS)).alias("c")).select("period", "source", "c.*")


def outcome(period: Column, version: Column, cutoff_days: int) -> Column:
    """``on_time``, ``corrects`` (1 to cut-off days late), ``too_late``, or NULL without an arrival."""
    days = F.datediff(arrival_of(version), period)
    return F.when(days > cutoff_days, "too_late").when(days >= 1, "corrects").when(days.isNotNull(), "on_time")


def source_counters(slots: DataFrame, version: int, cutoff_days: int = 10) -> DataFrame:
    """period, source, version and what the source counts for the period; unknown arrivals count as on time."""
    o = F.coalesce(outcome(F.col("period"), F.col("version"), cutoff_days), F.lit("on_time"))
    counted = slots.withColumn("o", o).groupBy("period", "source").agg(*[F.count_if(F.col("o") == k).alias(k) for k in COUNTS])
    return counted.select("period", "source", F.lit(version).cast("bigint").alias("version"), *COUNTS)


def sum_sources(counters: DataFrame) -> DataFrame:
    """Per period: count as first known, corrections, corrected count, cases set apart as too late, and sources."""
    return counters.groupBy("period").agg(
        F.sum("on_time").alias("on_time"),
        F.sum("corrects").alias("corrections"),
        (F.sum("on_time") + F.sum("corrects")).alias("corrected_count"),
        F.sum("too_late").alias("too_late"),
        F.count("source").alias("sources"),
    )


def period_counts(slots: DataFrame, cutoff_days: int = 10) -> DataFrame:
    """Counts of a state. Slots are added up per source first and sources per period after that, so a period or
    a source with most of the rows is combined on the map side."""
    return sum_sources(source_counters(slots, 0, cutoff_days))


class CounterStore:
    """Counters below a path: what is merged in stays, also for another session; one writer at a time.

    A merge reads and writes only the slots of the periods its batch touches. It writes new slots and the merged
    counters (one row a period and source) beside the old ones and then one manifest, named by its number, that
    says for each period which slots hold; the greatest number counts, so a failure at any point leaves the
    state before. Files that no manifest needs any more are deleted one merge later.
    """

    SLOTS = "period date, source string, sequence string, version bigint"
    COUNTERS = "period date, source string, version bigint, on_time bigint, corrects bigint, too_late bigint"

    def __init__(self, spark: SparkSession, path: str | None = None, cutoff_days: int = 10):
        self.spark, self.cutoff_days = spark, cutoff_days
        self.path = (path or work_path(spark, "counters")).rstrip("/")

    def _numbers(self) -> list[int]:
        return sorted(int(n.split("-")[1]) for n in child_names(self.spark, self.path) if n.startswith("_manifest-"))

    def _manifest(self, n: int | None = None) -> dict:
        """slots: number -> periods whose newest slots are there; counters: the number of the newest; closed: periods
        before it take no more."""
        numbers = self._numbers()
        if not numbers:
            return {"slots": {}, "counters": None, "closed": None}
        return json.loads(read_file(self.spark, f"{self.path}/_manifest-{numbers[-1] if n is None else n}"))

    def _slots(self, manifest: dict, periods: set[str] | None = None) -> list[DataFrame]:
        out = []
        for n, held in manifest["slots"].items():
            wanted = sorted(set(held) & periods if periods is not None else held)
            if wanted:
                out.append(self.spark.read.parquet(f"{self.path}/slots-{n}").where(F.col("period").isin(*[F.lit(d).cast("date") for d in wanted])))
        return out

    def _counters(self, manifest: dict) -> list[DataFrame]:
        return [self.spark.read.parquet(f"{self.path}/counters-{manifest['counters']}")] if manifest["counters"] else []

    def slots(self) -> DataFrame:
        parts = self._slots(self._manifest())
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.SLOTS)

    def counters(self) -> DataFrame:
        parts = self._counters(self._manifest())
        return parts[0] if parts else self.spark.createDataFrame([], self.COUNTERS)

    def counts(self) -> DataFrame:
        """:func:`sum_sources` of the counters, the closed periods' among them."""
        return sum_sources(self.counters())

    def set_apart(self) -> DataFrame:
        """Slots that came for a closed period: too late to count."""
        names = [f"{self.path}/{n}" for n in child_names(self.spark, self.path) if n.startswith("apart-") and int(n.split("-")[1]) <= max(self._numbers(), default=0)]
        return merge_slots(self.spark.read.parquet(*names)) if names else self.spark.createDataFrame([], self.SLOTS)

    def merge(self, delta: DataFrame) -> None:
        """Merges a batch of slots into the state; the same batch again changes nothing."""
        now, n = self._manifest(), max(self._numbers(), default=0) + 1
        delta = stored(delta.select(*SLOT, "version").where("period is not null"), "delta")
        if now["closed"]:
            late = F.col("period") < F.lit(now["closed"]).cast("date")
            delta.where(late).write.mode("overwrite").parquet(f"{self.path}/apart-{n}")
            delta = delta.where(~late)
        # As many as the calendar has days.
        touched = {str(r.period) for r in delta.select("period").distinct().collect()}
        # Sorted by period within a file, so that a later merge reads only the row groups of its periods.
        merge_slots(delta, *self._slots(now, touched)).sortWithinPartitions("period").write.mode("overwrite").parquet(f"{self.path}/slots-{n}")
        fresh = source_counters(self.spark.read.parquet(f"{self.path}/slots-{n}"), n, self.cutoff_days)
        merge_counters(fresh, *self._counters(now)).write.mode("overwrite").parquet(f"{self.path}/counters-{n}")
        held = {k: sorted(set(v) - touched) for k, v in now["slots"].items()} | {str(n): sorted(touched)}
        now["slots"], now["counters"] = {k: v for k, v in held.items() if v}, n
        self._name(n, now)

    def evict(self, watermark: str) -> None:
        """Closes the periods whose cut-off lies before the watermark (a day): their slots are dropped, their
        counters stay. What still comes for them is set apart and not counted."""
        now, n = self._manifest(), max(self._numbers(), default=0) + 1
        closed = str(date.fromisoformat(watermark) - timedelta(days=self.cutoff_days))
        now["closed"] = max(closed, now["closed"] or closed)
        held = {k: [p for p in v if p >= now["closed"]] for k, v in now["slots"].items()}
        now["slots"] = {k: v for k, v in held.items() if v}
        self._name(n, now)

    def _name(self, n: int, manifest: dict) -> None:
        create_file(self.spark, f"{self.path}/_manifest-{n}", json.dumps(manifest))
        keep = [self._manifest(k) for k in self._numbers()[-2:]]
        for name in child_names(self.spark, self.path):
            kind, number = name.split("-")
            unused = kind == "slots" and all(number not in m["slots"] for m in keep) or kind == "counters" and all(int(number) != m["counters"] for m in keep)
            if unused or (kind == "_manifest" and int(number) < n - 1):
                delete_path(self.spark, f"{self.path}/{name}")


def ranked(messages: DataFrame, *keep: str) -> DataFrame:
    """msg_id, payload_id, ``keep`` and the version of each delivery: its readable reception, else its ingest date."""
    read, filed = version_of(utc_day(F.col("moment")), F.lit(True)), version_of(F.col("ingest_date").try_cast("date"), F.lit(False))
    return deliveries(messages, *keep).select("msg_id", "payload_id", *keep, F.coalesce(read, filed).alias("version"))


def arrivals(rows: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """msg_id -> version of :func:`ranked` deliveries: the earliest readable reception, else the smallest ingest date.

    ``links``: payload_id -> link_id over all deliveries, where ``rows`` are only a batch of them."""
    nameless = (
        rows.where(F.col("msg_id").isNull() & F.col("payload_id").isNotNull())
        .groupBy("payload_id")
        .agg(F.max("version").alias("version"))
        .join(payload_links(rows) if links is None else links, "payload_id")
        .select(F.col("link_id").alias("msg_id"), "version")
    )
    return rows.where(F.col("msg_id").isNotNull()).select("msg_id", "version").unionByName(nameless).groupBy("msg_id").agg(F.max("version").alias("version"))


def known_cases(cases: DataFrame) -> DataFrame:
    """msg_id and the slot (period = report date, source = facility, sequence = message control id) of each case with a report date.

    Defined results: cases loaded twice are one; NULL facilities form one source; an empty table gives none.
    """
    return (
        cases.where(F.col("report_date").isNotNull() & F.col("message_control_id").isNotNull())
        .groupBy(
            identifier_bytes(plain_identifier(F.col("message_id"))).alias("msg_id"),
            F.col("report_date").cast("date").alias("period"),
            F.col("message_control_id").alias("sequence"),
        )
        .agg(F.min("facility_id").alias("source"))
    )


def case_slots(cases: DataFrame, messages: DataFrame) -> DataFrame:
    """A state with one slot per known case; one none of whose deliveries is known has a NULL version."""
    return merge_slots(known_cases(cases).join(arrivals(ranked(messages)), "msg_id", "left").select(*SLOT, "version"))


def merged_batches(cases: DataFrame, messages: DataFrame, store: CounterStore | None = None, batches: int = 2) -> CounterStore:
    """The state after the messages were merged in batches, as they came in. The first batch makes all cases
    known, also those none of whose deliveries is. Messages are read once and kept as a few narrow columns."""
    spark = cases.sparkSession
    store = store or CounterStore(spark)
    known = stored(known_cases(cases), "known-cases")
    rows = stored(ranked(messages, "_ingest_ts"), "ranked")
    links = stored(payload_links(rows), "payload-links")
    for n, batch in enumerate(in_batches(rows, batches)):
        store.merge(known.join(arrivals(batch, links), "msg_id", "inner" if n else "left").select(*SLOT, "version"))
    return store


def late_cases(state: DataFrame, cutoff_days: int = 10) -> DataFrame:
    """message_control_id and outcome of the slots that corrected a period or came too late."""
    o = outcome(F.col("period"), F.col("version"), cutoff_days)
    return state.select(F.col("sequence").alias("message_control_id"), o.alias("outcome")).where(
        F.col("outcome").isin("corrects", "too_late")
    )
