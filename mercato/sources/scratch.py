"""A fresh folder for tables that a job writes and reads again."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; a local folder only under a local master without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="mercato-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
