"""Session defaults and the shared scratch folder used to cut long lineages."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording a Python call site per column expression dominates planning time of wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(master: str | None = None, app: str = "riskweave", **conf: str) -> SparkSession:
    """A session with the settings the library relies on; `conf` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed."""
    context, name = spark.sparkContext, "riskweave.zip"
    if name in context._python_includes:
        return
    package = Path(__file__).resolve().parent
    # The stateful operator also starts a Python process beside the driver, which gets no shipped files.
    paths = [str(package.parent), context.environment.get("PYTHONPATH", "")]
    context.environment["PYTHONPATH"] = os.pathsep.join(p for p in paths if p)
    target = Path(tempfile.mkdtemp(prefix="riskweave-code-")) / "riskweave"
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))


def scratch_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session may go without one and gets a temporary one."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current.rstrip("/")
    active = spark.sparkContext.getCheckpointDir()
    if active is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        active = tempfile.mkdtemp(prefix="riskweave-checkpoint-")
        spark.sparkContext.setCheckpointDir(active)
        active = spark.sparkContext.getCheckpointDir()
    return active.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder so that a lost executor does not replay its lineage."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)
