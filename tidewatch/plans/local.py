"""Running the registered queries on one machine."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def ensure_shared_folder(spark: SparkSession) -> None:
    """Name a folder for a session on a single machine that names none. A cluster has to name one itself."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.startswith("local") and not context.master.startswith("local-cluster"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
