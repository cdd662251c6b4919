"""Structured Streaming forms of the pipeline. Every stream ends when all files there are read, and a
second start with the same checkpoint adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.late import CounterStore
from caseloom.session import work_path


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1_000) -> DataFrame:
    """A Parquet table, one file or a directory of them, as a stream with the schema it has now."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(where).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", where.getName()).parquet(str(where.getParent().toString()))


def ingest_to_bronze(spark: SparkSession, path: str, target: str | None = None, checkpoint: str | None = None, runs: int = 1, files_per_day: int = 2) -> DataFrame:
    """Appends messages to a table partitioned by ingest date, exactly once per file. ``runs`` starts are made; each goes on where the last ended."""
    base = work_path(spark, "stream-ingest")
    target, checkpoint = target or f"{base}/bronze", checkpoint or f"{base}/checkpoint"
    for _ in range(runs):
        # A day is written by a few tasks, not by each that read some of it: few files, and a busy day is still split.
        (
            file_stream(spark, path)
            .repartition(F.col("ingest_date"), F.pmod(F.xxhash64("message_id"), F.lit(files_per_day)))
            .writeStream.format("parquet")
            .partitionBy("ingest_date")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return spark.read.parquet(target)


def daily_counts(spark: SparkSession, path: str, time: str, keys: list[str], lateness: str = "400 days", base: str | None = None) -> DataFrame:
    """day, keys, n by event time. A late row corrects its day; days beyond the watermark leave the stream's state.

    A batch writes the days it changed as its own part (a repeated batch replaces it); of a day's counts the
    latest holds. ``base``: where counts and checkpoint are kept, to continue with the files that came since.
    """
    base = base or work_path(spark, "stream-daily")
    counts = (
        file_stream(spark, path)
        .withColumn("_t", F.col(time).cast("timestamp"))
        .withWatermark("_t", lateness)
        .groupBy(F.window("_t", "1 day").alias("w"), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").cast("date").alias("day"), *keys, "n")
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/counts/batch={number}")

    counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    parts = spark.read.option("basePath", f"{base}/counts").parquet(f"{base}/counts")
    return parts.groupBy("day", *keys).agg(F.max_by("n", "batch").alias("n"))


def first_of_each(spark: SparkSession, path: str, key: str, time: str, lateness: str = "400 days") -> DataFrame:
    """The first row of each key within the watermark. Rows without key or time have no identity and are left out."""
    base = work_path(spark, "stream-first")
    rows = file_stream(spark, path).where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_t", F.col(time).cast("timestamp"))
    unique = rows.withWatermark("_t", lateness).dropDuplicatesWithinWatermark([key]).drop("_t")
    unique.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/rows")


def merge_state(spark: SparkSession, delta: DataFrame, path: str, watermark: str | None = None) -> DataFrame:
    """Merges a batch of counter slots into the state below ``path`` (its own folder, not the work folder), closes
    the periods beyond the cut-off if a watermark is given, and gives the counts of all periods."""
    store = CounterStore(spark, path)
    store.merge(delta)
    if watermark:
        store.evict(watermark)
    return store.counts()
