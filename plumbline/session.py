"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def get_session(app_name: str = "plumbline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are planned for; `conf` wins over them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from `spark.checkpoint.dir`.

    Only a local master gets a temporary folder when the setting is absent: on
    a cluster an intermediate table has to outlive the machine that wrote it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/plumbline/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="plumbline-")
    return _local_dirs[app].name


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def spool(df: DataFrame, label: str = "spool") -> DataFrame:
    """Write `df` to the work folder and read it back.

    Cuts the lineage, computes the input once however often it is read, and
    gives Catalyst true sizes for the joins that follow.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_work_dir(spark: SparkSession) -> None:
    """Delete this application's intermediate tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
