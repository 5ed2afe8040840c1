"""Folders for tables that a query stores and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share; on one machine (tests) a local one if none is named."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="courtside-")
    return f"{found.rstrip('/')}/scratch/{uuid.uuid4().hex}"
