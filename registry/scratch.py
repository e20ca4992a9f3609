"""Where round-trip queries write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder the session names.

    Only a local session without that setting falls back to a local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="hiatus-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
