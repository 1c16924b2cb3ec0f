"""Where queries that write and read back put their files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir).

    Only a session of one process may do without: it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/firmloom-{uuid.uuid4().hex}/{name}"
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix='run-', dir='/tmp')}/{name}"
