"""Session builder and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """What differs between places; read once and passed on. Unknown backends are refused."""

    base: str = ""
    table_format: str = "parquet"
    model_name: str = "outbreak"
    llm_backend: str = "rules"
    llm_url: str = ""
    model_deployment: str = "default"
    search_backend: str = "bm25"
    search_url: str = ""

    def __post_init__(self):
        for name, known in (("llm_backend", ("rules", "remote")), ("search_backend", ("bm25", "remote"))):
            if getattr(self, name) not in known:
                raise ValueError(f"unknown {name} {getattr(self, name)!r}")
        for name in ("llm", "search"):
            if getattr(self, f"{name}_backend") == "remote" and not getattr(self, f"{name}_url"):
                raise ValueError(f"a remote {name} needs {name}_url")

    @classmethod
    def from_env(cls, env=os.environ) -> Settings:
        """CASELOOM_BASE, CASELOOM_TABLE_FORMAT, ... where they are set."""
        return cls(**{f: env[k] for f in cls.__dataclass_fields__ if (k := f"CASELOOM_{f.upper()}") in env})


def get_spark(app: str = "caseloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares: ``spark.checkpoint.dir``.

    Only where that setting is missing and the master is local (tests) a folder of this machine is made
    and set, so that one session always uses one folder; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="caseloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/caseloom/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """(file system, path) as the JVM has them; any file system Spark knows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder with all in it; nothing where it is not there."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def clear_work(spark: SparkSession) -> None:
    """Deletes what operators of this library left in the shared folder. Frames that still read it fail afterwards."""
    delete_path(spark, f"{shared_dir(spark)}/caseloom")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; any other failure to look is raised, not taken for absence."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where it is not there."""
    fs, where = _file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def create_file(spark: SparkSession, path: str, text: str = "") -> None:
    """A new small file; fails where it is there already, so that of two writers one wins."""
    fs, where = _file_system(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, where = _file_system(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def local_master() -> str:
    """The master used by tests and the bench."""
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"


def stored(df, name: str):
    """Written to the shared folder and read back: work done once, and lineage cut so that a lost executor costs nothing."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
