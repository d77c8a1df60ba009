"""A folder that driver and executors share, for what a query writes on its way."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_own: str | None = None


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; one of its own, removed at exit, only where a local master leaves that unset."""
    global _own
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"{CHECKPOINT_CONF} has to name a folder that driver and executors share")
        if _own is None:
            _own = tempfile.mkdtemp(prefix="curatrix-")
            atexit.register(shutil.rmtree, _own, ignore_errors=True)
        shared = f"file://{_own}"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
