"""Session settings and the shared folder for checkpoints and stream output."""

from __future__ import annotations

import os
import re
import uuid
from pathlib import Path

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import SparkSession

# Settings that matter for the jobs in this package. The caller owns the
# session and may override any of them. Streaming state is kept by RocksDB,
# which holds more than fits in executor memory.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Adaptive execution only merges partitions, so shuffles begin with many. It does not
    # rule streams: their state keeps the spark.sql.shuffle.partitions of its first run.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS applied; keyword settings use `__` for `.`.

    A given number of shuffle partitions is also what adaptive execution begins with.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    settings = {name.replace("__", "."): value for name, value in settings.items()}
    if shuffles := settings.get("spark.sql.shuffle.partitions"):
        settings.setdefault("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffles)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where it was imported here.

    On a cluster it is installed or sent with the job; on one machine this finds it from
    any working folder.
    """
    place = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if place not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, place])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by `spark.checkpoint.dir`.

    Where that is unset, as in tests, it is the session's warehouse folder, which
    every session has and all executors share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, for one run of one job."""
    return f"{shared_dir(spark)}/tallybrook/{name}-{uuid.uuid4().hex}"


def remove_runs(spark: SparkSession, *folders: str) -> None:
    """Remove finished runs: the folders named, or every run under the shared folder.

    Only what `run_dir` has made is removed; do it when no result that reads
    those folders is needed any more. The store must be one that Arrow reaches.
    """
    top = f"{shared_dir(spark)}/tallybrook"
    for folder in folders or (top,):
        if folder != top and not folder.startswith(f"{top}/"):
            raise ValueError(f"not a run folder: {folder}")
        # Spark also writes a local URI with one slash.
        system, path = FileSystem.from_uri(re.sub("^file:/+", "/", folder))
        if system.get_file_info(path).type == FileType.Directory:
            system.delete_dir(path)
