"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """All time text without an offset is read as UTC, so pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app: str = "limnia", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the session names for cut lineage, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_path(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, deleted when the session's JVM ends.

    A cluster must name a folder there that all its machines share. Only a local master may go
    without; it then gets a temporary folder, so that plans are the same everywhere.
    """
    root = checkpoint_dir(spark)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="limnia-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/limnia/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Later steps then neither recompute it nor guess its size: the planner broadcasts the
    written table only if its real size is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
