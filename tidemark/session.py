"""Session settings, and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# What every deployment should run with. Partition counts and memory belong to
# the cluster and are left to it: AQE starts from many small shuffle partitions
# and merges them to the advisory size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    # frozen rows are deleted once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(name: str, cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    local = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in {**SETTINGS, **local, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    Only a local session may go without it; a cluster without it is an error,
    since a folder of one machine is lost with that machine.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, prefix: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return os.path.join(shared_dir(spark), f"{prefix}-{os.urandom(6).hex()}")
