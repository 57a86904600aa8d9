"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows one key may hold before its ordered work is split over several tasks.
HOT_KEY_ROWS_CONF = "spark.siltstone.hotKeyRows"
DEFAULT_HOT_KEY_ROWS = 2_000_000


def build_session(app: str = "siltstone", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the library relies on; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on to a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def hot_key_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_KEY_ROWS_CONF, str(DEFAULT_HOT_KEY_ROWS)))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in spark.checkpoint.dir."""
    base, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not base:
        base = context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "siltstone-checkpoints")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/siltstone/{name}-{uuid.uuid4().hex}"
