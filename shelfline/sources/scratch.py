"""A folder that the driver and every executor reach, for files between jobs."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

#: Used only where spark.checkpoint.dir is unset and the session has no other machines.
LOCAL_SHARED = "/tmp/checkpoints"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which a session on a cluster must set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder shared by driver and executors")
        base = LOCAL_SHARED
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
