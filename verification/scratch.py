"""Folders for the queries that write and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder path that every executor can reach.

    A cluster names its shared folder in spark.checkpoint.dir. Only where that is unset and
    Spark runs inside one machine is a local folder taken.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="salesmart-")
    return f"{shared.rstrip('/')}/salesmart-{uuid.uuid4().hex}"
