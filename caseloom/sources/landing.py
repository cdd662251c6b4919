"""Sources and sinks: landing files, format-neutral tables, the ingest log, layered paths, sidecars."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.incremental import IncrementalLoad
from caseloom.session import create_file, delete_path, path_exists, read_file

#: Fixed values.
LAYERS = ("landing", "bronze", "silver", "quarantine", "gold", "feature", "ml")
LANDING_SCHEMA = "message_id string, source_system string, received_at string, payload_hl7 string"
LOG_SCHEMA = "source_file string, _batch_id string, _ingest_ts timestamp"
BRONZE_COLUMNS = ["message_id", "source_system", "received_at", "payload_hl7", "_payload_sha256", "ingest_date", "source_file", "_batch_id", "_ingest_ts"]


@dataclass(frozen=True)
class Lake:
    """Where tables are: a base address (local, or any file system Spark knows) and a format."""

    base: str
    table_format: str = "parquet"

    def uri(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; one of {', '.join(LAYERS)}")
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.format(self.table_format).load(self.uri(layer, table))

    def read_or_empty(self, spark: SparkSession, layer: str, table: str, schema: str) -> DataFrame:
        """An empty frame only where the table does not exist; any other failure to read is raised."""
        return self.read(spark, layer, table) if path_exists(spark, self.uri(layer, table)) else spark.createDataFrame([], schema)

    def write(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
        w = df.write.mode(mode).format(self.table_format)
        (w.partitionBy(*partition_by) if partition_by else w).save(self.uri(layer, table))


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON below ``ingest_date=`` directories with a fixed schema, and the file each row came from."""
    raw = spark.read.schema(LANDING_SCHEMA).option("basePath", path).json(f"{path}/ingest_date=*/*")
    return raw.select("*", F.col("_metadata.file_path").alias("source_file")).withColumn("ingest_date", F.col("ingest_date").cast("string"))


def write_landing(messages: DataFrame, path: str) -> None:
    """One directory of NDJSON per ingest date, in up to 8 files, so that a busy day is not one task's."""
    messages.repartition("ingest_date", F.pmod(F.xxhash64("message_id"), F.lit(8))).write.mode("overwrite").partitionBy("ingest_date").json(path)


def not_ingested(raw: DataFrame, log: DataFrame, key: str = "source_file") -> DataFrame:
    """Rows of files the log does not have. The log grows with the data, so the join strategy is left to its size."""
    return raw.join(log.select(key).distinct(), key, "left_anti")


def with_lineage(raw: DataFrame, batch_id: str) -> DataFrame:
    return raw.withColumns({"_payload_sha256": F.sha2("payload_hl7", 256), "_batch_id": F.lit(batch_id), "_ingest_ts": F.current_timestamp()}).select(*BRONZE_COLUMNS)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """source_file of every file that has landed, from a listing: no file is opened."""
    return spark.read.format("binaryFile").load(f"{path}/ingest_date=*/*").select(F.col("_metadata.file_path").alias("source_file"))


def land_to_bronze(spark: SparkSession, lake: Lake, landing: str | None = None, batch_id: str | None = None) -> dict:
    """Appends the messages of new files, then logs the files; a second run adds nothing.

    The files of a run are written down first. A run that failed is taken up again under its own batch
    name with its own files: bronze is partitioned by ingest date and batch, so its partitions are replaced
    and no message is there twice; the log has one part for each run, replaced likewise.
    """
    where = landing or lake.uri("landing", "ecr")
    load = IncrementalLoad(spark, lake.uri("bronze", "_loads"))
    logged = lake.read_or_empty(spark, "bronze", "_ingest_log", LOG_SCHEMA)
    plan, batch_id = load.prepared(lambda: not_ingested(landed_files(spark, where), logged), batch_id or str(uuid.uuid4()))
    fresh = with_lineage(read_landing(spark, where).join(plan, "source_file", "left_semi"), batch_id)
    replace = lambda df, name, *by: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(lake.table_format).partitionBy(*by).save(lake.uri("bronze", name))
    if plan.isEmpty():
        load.finish()
        return {"rows": 0, "files": 0, "batch_id": batch_id}
    replace(fresh, "ecr_messages", "ingest_date", "_batch_id")
    rows = lake.read(spark, "bronze", "ecr_messages").where(F.col("_batch_id") == batch_id).count()
    replace(plan.select("source_file", F.lit(batch_id).alias("_batch_id"), F.current_timestamp().alias("_ingest_ts")), "_ingest_log", "_batch_id")
    load.finish()
    return {"rows": rows, "files": plan.count(), "batch_id": batch_id}


def read_json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON document (object or array) per file."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose files differ in columns, united by name."""
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "false").parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """A view of the session under a name, as staging models are."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_single_file(df: DataFrame, path: str) -> None:
    """One Parquet file, for small results that other tools read."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_sidecar(spark: SparkSession, content: dict | list, path: str) -> None:
    """A small JSON file beside a table, on any file system Spark knows: contracts, reports."""
    delete_path(spark, path)
    create_file(spark, path, json.dumps(content, indent=2, default=str))


def read_sidecar(spark: SparkSession, path: str) -> dict:
    return json.loads(read_file(spark, path))
