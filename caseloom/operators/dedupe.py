"""Problem 3: messages delivered more than once.

A store keeps entries in hash buckets, sorted by identifier: for each identifier its first delivery,
for each payload the identifiers it came under and the first delivery without one. An upsert collapses
its batch and appends one sorted run to the buckets; nothing is read back, and the same batch twice
changes nothing, because the smallest entry wins. Compaction merges the runs of each bucket into one
and drops them: the table is bucketed by the key, so equal keys meet without a shuffle.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.identity import deliveries, in_batches
from caseloom.session import child_names, create_file, delete_path, work_path

#: Columns of the buckets. ``link``: the identifier a payload came under; ``first``: see :func:`first_order`.
ENTRY = "kind tinyint, key binary, link binary, first decimal(38,0)"
_ROWS, _SHIFT, _UNREAD = Decimal(10**20), Decimal(2**63), 10**18 - 1


def first_order(moment: Column, row_id: Column) -> Column:
    """Moment, unreadable ones last, then row_id as one number: a minimum of it needs no sort, unlike one of structs."""
    when = F.coalesce(moment, F.lit(_UNREAD)).cast("decimal(18,0)")
    row = row_id.cast("decimal(20,0)") + F.lit(_SHIFT)
    return (when * F.lit(_ROWS) + row).cast("decimal(38,0)")


def row_of(first: Column) -> Column:
    """The row_id of a :func:`first_order`."""
    return (F.pmod(first, F.lit(_ROWS)) - F.lit(_SHIFT)).cast("bigint")


class MessageStore:
    """Hash-bucketed, sorted storage of first deliveries below a path, for one writer at a time.

    The same path opened again, also by another session, continues with what is there. A compaction
    writes a new generation beside the old one and then names it in one step, so a failure leaves the old
    one; the generation before that is deleted, so frames read earlier stay good until the next compaction.
    ``buckets`` (shuffle partitions by default) counts when a store is made; later it has those it has.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = (path or work_path(spark, "messages")).rstrip("/")
        if not self._generations():
            create_file(spark, f"{self.path}/_generation-0-{buckets or int(spark.conf.get('spark.sql.shuffle.partitions'))}")

    def _generations(self) -> list[tuple[int, int]]:
        """(number, buckets) of the generations that were finished, oldest first."""
        return sorted(tuple(map(int, n.split("-")[1:])) for n in child_names(self.spark, self.path) if n.startswith("_generation-"))

    @property
    def buckets(self) -> int:
        return self._generations()[-1][1]

    def _table(self, generation: int, buckets: int) -> str:
        """The generation's table in this session's catalogue, under a name that follows from its path."""
        where = f"{self.path}/generation-{generation}"
        name = f"caseloom_messages_{hashlib.sha256(where.encode()).hexdigest()[:24]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ENTRY}) USING parquet CLUSTERED BY (key) SORTED BY (key, kind, link) INTO {buckets} BUCKETS LOCATION '{where}'")
        self.spark.catalog.refreshTable(name)
        return name

    def _append(self, entries: DataFrame, generation: int, buckets: int) -> None:
        """``entries`` are clustered by key into as many partitions as there are buckets: one file a bucket."""
        entries.select("kind", "key", "link", "first").write.insertInto(self._table(generation, buckets))

    def upsert(self, rows: DataFrame) -> None:
        """Appends a run. ``rows``: row_id, msg_id, payload_id, moment as of :func:`identity.deliveries`.

        Collapsing first (map-side combined) leaves one entry per identifier and one per identifier and
        payload, so an identifier with a third of all rows is no larger in its bucket than any other.
        """
        generation, buckets = self._generations()[-1]
        order = first_order(F.col("moment"), F.col("row_id"))
        named = F.col("msg_id").isNotNull()
        entry = lambda kind, key, link, first: F.struct(F.lit(kind).cast("tinyint").alias("kind"), key.alias("key"), link.alias("link"), first.alias("first"))
        nothing, never = F.lit(None).cast("binary"), F.lit(None).cast("decimal(38,0)")
        alone = F.coalesce("payload_id", F.col("row_id").cast("string").cast("binary"))
        both = F.array_compact(F.array(
            F.when(named, entry(0, F.col("msg_id"), nothing, order)),
            F.when(named & F.col("payload_id").isNotNull(), entry(1, F.col("payload_id"), F.col("msg_id"), never)),
            F.when(~named, entry(1, alone, nothing, order)),
        ))
        run = rows.select(F.inline(both)).groupBy("kind", "key", "link").agg(F.min("first").alias("first"))
        self._append(run.repartition(buckets, "key"), generation, buckets)

    def entries(self) -> DataFrame:
        return self.spark.table(self._table(*self._generations()[-1]))

    def _merged(self) -> DataFrame:
        return self.entries().groupBy("kind", "key", "link").agg(F.min("first").alias("first"))

    def compact(self) -> None:
        """Merges the runs of each bucket into one and drops them; equal entries collapse."""
        finished = self._generations()
        last, buckets = finished[-1]
        # Left behind by a compaction that failed.
        delete_path(self.spark, f"{self.path}/generation-{last + 1}")
        self._append(self._merged(), last + 1, buckets)
        create_file(self.spark, f"{self.path}/_generation-{last + 1}-{buckets}")
        for old, _ in finished[:-1]:
            delete_path(self.spark, f"{self.path}/_generation-{old}-{buckets}")
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(old, buckets)}")
            delete_path(self.spark, f"{self.path}/generation-{old}")

    def kept(self) -> DataFrame:
        """The row_id kept of each message: earliest moment, unreadable ones last, then the smallest row_id.

        Only deliveries without identifier are shuffled, to the identifier their payload came under."""
        merged = self._merged()
        named = merged.where("kind = 0").select("key", "first")
        payloads = merged.where("kind = 1")
        nameless = payloads.where("link is null and first is not null").select("key", F.col("first").alias("nameless"))
        links = payloads.where("link is not null").groupBy("key").agg(F.min("link").alias("link"))
        linked = (
            nameless.join(links, "key", "left")
            .groupBy(F.coalesce("link", "key").alias("key"))
            .agg(F.min("nameless").alias("nameless"))
        )
        return named.join(linked, "key", "full").select(row_of(F.least("first", "nameless")).alias("row_id"))

    def close(self) -> None:
        """Takes the names out of the session's catalogue; the files stay."""
        for g in self._generations():
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(*g)}")


def kept_rows(messages: DataFrame, store: MessageStore | None = None, batches: int = 2) -> DataFrame:
    """row_id of the one delivery kept of each message: an upsert for each batch, then a compaction."""
    store = store or MessageStore(messages.sparkSession)
    for batch in in_batches(messages, batches):
        store.upsert(deliveries(batch))
    store.compact()
    return store.kept()


def removed_rows(messages: DataFrame, store: MessageStore | None = None, batches: int = 2) -> DataFrame:
    """row_id of every delivery to be removed.

    Defined results: NULL and blank identifiers fall back to the payload; a NULL or blank payload
    without identifier is a message of its own; ties in the moment go to the smallest row_id; an
    empty table gives no rows; further columns are ignored.
    """
    return messages.select("row_id").join(kept_rows(messages, store, batches), "row_id", "left_anti")


