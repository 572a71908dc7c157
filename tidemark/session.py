"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; `conf` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Recording the Python line of every column expression doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables, which the driver and all executors must share.

    It is `spark.checkpoint.dir`, or what `SparkContext.setCheckpointDir` set; one of them is
    required, since no folder of one machine would do on a cluster.
    """
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getCheckpointDir())
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder.rstrip("/")


@functools.cache
def _run_folder(spark: SparkSession) -> str:
    """This session's folder under the scratch root, removed when the session's JVM ends."""
    folder = f"{scratch_root(spark)}/tidemark/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    file_system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(path)
    file_system.deleteOnExit(path)
    return folder


def new_scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_run_folder(spark)}/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and later readers still
    prune columns and push filters.
    """
    path = new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """`materialise`, and aggregates of the rows gathered while they are written."""
    seen = Observation()
    written = materialise(df.observe(seen, *(m.alias(k) for k, m in metrics.items())), name)
    return written, seen.get


def new_scratch_database(spark: SparkSession) -> str:
    """A database of its own in the scratch folder; its tables leave with the session."""
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_scratch_path(spark, name)}'")
    return name
