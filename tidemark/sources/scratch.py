"""Where intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_fallback() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting falls back to a temporary folder: on a
    cluster the executors could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_fallback()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
