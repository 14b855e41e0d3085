"""Paths for intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """Below spark.checkpoint.dir; only a master of one process without it gets a temporary folder."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="gleanery-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/gleanery-{context.applicationId}/{name}-{uuid.uuid4().hex}"
