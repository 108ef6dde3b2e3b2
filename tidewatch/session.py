"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "tidewatch", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings this package expects; `extra` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir` of the session.

    Where the cluster names none, the checkpoint folder set on the context is used. There is no
    machine-local fallback: a job that needs the folder fails early without one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the application's part of the shared folder, which is deleted when the driver ends."""
    context = spark.sparkContext
    own = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tidewatch-{context.applicationId}")
    store = own.getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(own)
    store.deleteOnExit(own)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder, so that later uses do not recompute it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
