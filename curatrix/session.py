"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def session(name: str = "curatrix", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators assume; ``conf`` wins over them.

    Memory limits, scratch folders and threads are the cluster's to set: pass them in ``conf``
    (``spark.executor.memory``, ``spark.local.dir``, ``spark.executor.cores``).
    """
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | conf)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()
