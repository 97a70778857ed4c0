"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE picks join strategies from measured sizes, coalesces small shuffle
# partitions and splits skewed ones, so no operator has to hint them.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles methods above 8000 bytes of bytecode: rather split such stages.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "tabulon", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session with the settings this library expects.

    Cluster sizing (executors, memory, shuffle partitions) is left to
    spark-submit; pass ``extra`` to override any setting, with ``__`` for dots.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabulon-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused between runs."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
