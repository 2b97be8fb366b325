"""Session defaults the operators rely on."""

from __future__ import annotations

import os
import shutil
import tempfile
from functools import cache

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rn = 1 filters over ranking windows are cut down to one row per key before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.parquet.aggregatePushdown": "true",
    # a standing stream checkpoints in every batch: files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "sparkwatch", master: str | None = None, **conf) -> SparkSession:
    """Session with the defaults above; master, memory and cores are left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which load its functions by name, once per application."""
    _ship(spark.sparkContext.applicationId, spark)


@cache
def _ship(application: str, spark: SparkSession) -> None:
    package = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(package):
        return  # it runs from an archive that was shipped already
    folder = tempfile.mkdtemp(prefix=f"{os.path.basename(package)}-package-")  # the driver's own: executors fetch it from there
    archive = shutil.make_archive(os.path.join(folder, os.path.basename(package)), "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder of the cluster; a temporary folder only in local mode where none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_scratch(spark.sparkContext.applicationId)


@cache
def _local_scratch(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"sparkwatch-{application}-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make DataFrame.checkpoint() usable without overriding a folder the cluster has set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
