"""Session defaults and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job needs for right results; all can be set at run time.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only affect speed. A session that sets them keeps its own.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "tallyframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword arguments use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PLAN_SETTINGS, **RESULT_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> SparkSession:
    """Prepare a session somebody else built: settings results depend on are set, those for
    speed only where the session has none of its own."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in PLAN_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` where the cluster names one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("executors share no folder: set spark.checkpoint.dir to one that all of them reach")
    fallback = tempfile.mkdtemp(prefix="tallyframe-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses. Spark creates it on first write."""
    return f"{shared_root(spark).rstrip('/')}/tallyframe/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
