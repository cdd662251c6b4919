"""Problem 6: processing only new or changed records.

The ingest log is the change log: the offset of a partition (a file, however its path is written) is
the latest ``_ingest_ts`` a successful run has logged for it, or an earlier load here has committed. A
load first writes its batch plan - per file the half-open range of offsets it will take - and only then
reads rows by that plan. It ends with a commit record. Until that is there, the plan is found again by
the load's number and replayed as it is, so a failed load takes the same rows again, and the sink holds
each row once by key and offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.session import child_names, create_file, delete_path, path_exists, read_file, work_path

SUCCESS = r"^(ok|okay|done|success|successful|succeeded|succeed|successfully (completed|finished)|complete|completed|finished|passed|pass)[.!]*$"


def plain_path(path: Column) -> Column:
    """One spelling of a path: percent codes decoded, no scheme or host, single slashes, no ``.`` parts."""
    p = F.regexp_replace(path, r"^\s+|\s+$", "")
    p = F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p)
    p = F.regexp_replace(p, r"^(?i)file:(//(localhost)?(?=/))?", "")
    return F.regexp_replace(F.regexp_replace(p, r"/(\./)+", "/"), r"/{2,}", "/")


def succeeded(status: Column) -> Column:
    """Whether the wording of a run's status says that it ended well."""
    return F.coalesce(F.regexp_replace(F.lower(status), r"^\s+|\s+$", "").rlike(SUCCESS), F.lit(False))


def file_offsets(log: DataFrame, runs: DataFrame) -> DataFrame:
    """file -> offset: the latest entry of a successful run. One row per file."""
    good = runs.where(succeeded(F.col("run_status"))).select("_batch_id").distinct()
    return (
        log.join(good, "_batch_id", "left_semi")
        .groupBy(plain_path(F.col("source_file")).alias("file"))
        .agg(F.max("_ingest_ts").alias("offset"))
    )

#: Due rows of a file that one task joins; a file with more is dealt out over more tasks.
ROWS_PER_TASK = 1_000_000


class IncrementalLoad:
    """Loads below a path, one after the other, for one writer at a time. The same path continues where the last load ended.

    ``_plan-N`` says that plan N is whole (its text is the batch's name), ``_done-N`` that load N is; ``offsets-N``
    are the offsets after it. Each of these files is made in one step and after what it stands for, none hangs on ``_SUCCESS``.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, rows_per_task: int = ROWS_PER_TASK):
        self.spark, self.rows_per_task = spark, rows_per_task
        self.path = (path or work_path(spark, "load")).rstrip("/")

    def _numbers(self, kind: str) -> list[int]:
        return sorted(int(n.split("-")[1]) for n in child_names(self.spark, self.path) if n.startswith(f"{kind}-"))

    @property
    def number(self) -> int:
        """The load that runs or comes next: one more than the last that was committed."""
        return max(self._numbers("_done"), default=0) + 1

    def prepared(self, make_plan, batch: str) -> tuple[DataFrame, str]:
        """(plan, batch name) of this load: what was written for it before, else ``make_plan()``, written now."""
        n = self.number
        where, marker = f"{self.path}/plan-{n}", f"{self.path}/_plan-{n}"
        if not path_exists(self.spark, marker):
            make_plan().write.mode("overwrite").parquet(where)
            create_file(self.spark, marker, batch)
        return self.spark.read.parquet(where), read_file(self.spark, marker)

    def offsets(self, log: DataFrame, runs: DataFrame) -> DataFrame:
        """file -> offset by the log of good runs and by the loads committed here."""
        known = file_offsets(log, runs)
        if self.number > 1:
            known = known.unionByName(self.spark.read.parquet(f"{self.path}/offsets-{self.number - 1}"))
        return known.groupBy("file").agg(F.max("offset").alias("offset"))

    def plan(self, messages: DataFrame, log: DataFrame, runs: DataFrame) -> DataFrame:
        """file, after (exclusive, NULL: from the start), upto (inclusive), rows (due at most). Written once, then only read."""

        def make() -> DataFrame:
            ts = F.col("_ingest_ts")
            latest = messages.groupBy(plain_path(F.col("source_file")).alias("file")).agg(F.max(ts).alias("upto"), F.max(ts.isNull()).alias("undated"), F.count("*").alias("rows"))
            m, o = latest.alias("m"), self.offsets(log, runs).alias("o")
            return (
                m.join(o, F.col("m.file").eqNullSafe(F.col("o.file")), "left")
                .where(F.col("o.offset").isNull() | F.col("m.undated") | (F.col("m.upto") > F.col("o.offset")))
                .select("m.file", F.col("o.offset").alias("after"), "m.upto", "m.rows")
            )

        return self.prepared(make, f"load-{self.number}")[0]

    def take(self, messages: DataFrame, plan: DataFrame) -> DataFrame:
        """The messages of a plan.

        A file with more rows than a task should join is salted, into as many parts as its rows need; the salts
        of such files (at most one for each ``rows_per_task`` rows of the table) are joined on by their size.
        """
        parts = F.ceil(F.col("rows") / self.rows_per_task).cast("int")
        m = messages.withColumn("__file", plain_path(F.col("source_file")))
        hot = plan.where(F.col("rows") > self.rows_per_task).select(F.col("file").alias("__hot"), parts.alias("__parts"))
        salt = F.lit(0)
        if not hot.isEmpty():
            m = m.join(hot, F.col("__file").eqNullSafe(F.col("__hot")), "left")
            salt = F.coalesce(F.pmod(F.xxhash64("row_id"), F.col("__parts")), F.lit(0)).cast("int")
        m = m.withColumn("__salt", salt)
        p = plan.select(
            F.col("file").alias("__pf"), F.col("after").alias("__after"), F.col("upto").alias("__upto"), F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)).alias("__ps")
        )
        same = F.col("__file").eqNullSafe(F.col("__pf")) & (F.col("__salt") == F.col("__ps"))
        ts, after = F.col("_ingest_ts"), F.col("__after")
        # A row without _ingest_ts was never shown to be taken, so it is due.
        due = ts.isNull() | ((after.isNull() | (ts > after)) & (ts <= F.col("__upto")))
        return m.join(p, same).where(due).select(*[m[f"`{c}`"] for c in messages.columns])

    def sink(self, taken: DataFrame, path: str) -> None:
        """Writes the load's rows, each once by key and offset (row_id, _ingest_ts), as the sink's part ``load=N``.

        A replay replaces that part, so nothing has to be compared with the sink's history: rows with an
        offset are beyond those of earlier loads. Only undated rows can have been taken before; they alone
        are looked up among the undated rows of the committed parts.
        """
        n = self.number
        rows = taken.dropDuplicates(["row_id", "_ingest_ts"])
        done = self.sunk(path)
        if done is not None:
            there = done.where("_ingest_ts is null").select(F.col("row_id").alias("__k"))
            rows = rows.where("_ingest_ts is not null").unionByName(rows.where("_ingest_ts is null").join(there, F.col("row_id") == F.col("__k"), "left_anti"))
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/load={n}")

    def sunk(self, path: str) -> DataFrame | None:
        """The rows of the loads that were committed; None before the first."""
        parts = [n for n in child_names(self.spark, path) if n.startswith("load=") and int(n[5:]) < self.number]
        return self.spark.read.parquet(*[f"{path.rstrip('/')}/{p}" for p in sorted(parts)]) if parts else None

    def commit(self) -> None:
        """Records the load as done, with the offsets after it: the next load takes what comes later."""
        n = self.number
        plan = self.spark.read.parquet(f"{self.path}/plan-{n}").select("file", F.col("upto").alias("offset"))
        if n > 1:
            plan = plan.unionByName(self.spark.read.parquet(f"{self.path}/offsets-{n - 1}"))
        plan.where("offset is not null").groupBy("file").agg(F.max("offset").alias("offset")).write.mode("overwrite").parquet(f"{self.path}/offsets-{n}")
        self.finish()

    def finish(self) -> None:
        """Names the load as done; what belongs to loads before it is deleted."""
        n = self.number
        create_file(self.spark, f"{self.path}/_done-{n}")
        for name in child_names(self.spark, self.path):
            if int(name.split("-")[1]) < n:
                delete_path(self.spark, f"{self.path}/{name}")

    def run(self, messages: DataFrame, log: DataFrame, runs: DataFrame, path: str) -> int:
        """Plan, take, sink, commit; the rows that were loaded. After a failure at any point the same call carries on."""
        n = self.number
        self.sink(self.take(messages, self.plan(messages, log, runs)), path)
        rows = self.spark.read.parquet(f"{path.rstrip('/')}/load={n}").count()
        self.commit()
        return rows


def pending_rows(messages: DataFrame, log: DataFrame, runs: DataFrame, load: IncrementalLoad | None = None) -> DataFrame:
    """The rows no successful run has taken: what the load under way takes, by its written plan.

    Defined results: a batch missing from the runs, or without a good status, took nothing; a NULL
    path is a file of its own; a NULL _ingest_ts is due; empty tables give what they imply.
    """
    load = load or IncrementalLoad(messages.sparkSession)
    needed = messages.select("row_id", "source_file", "_ingest_ts")
    return load.take(needed, load.plan(needed, log, runs))
