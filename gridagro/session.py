"""Session settings and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# On a cluster the session is given; these are for local runs.
LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.driver.memory": "8g",
}


def local_session(cores: str = "*", app: str = "gridagro") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    A local session that names no such folder, as in tests, gets one of its own and keeps it. On a
    cluster a folder of one machine would not do, so there its absence is an error.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gridagro-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
