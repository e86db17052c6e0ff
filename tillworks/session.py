"""Session settings, the shared folder used to cut lineage, and the package for Python workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def build_session(app: str = "tillworks", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Session with the settings the plans rely on; anything the cluster sets wins over the defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where nothing is named, local mode gets a temporary folder that goes with the process. On a cluster
    such a folder would be gone with the machine that holds it, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    """One folder per application (the setting itself cannot be changed while a session runs)."""
    folder = tempfile.mkdtemp(prefix=f"tillworks-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


@cache
def _session_folder(shared: str, application: str) -> str:
    """The session's own folder in the shared one; the JVM removes it when the session's process ends."""
    spark = SparkSession.active()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/tillworks-{application}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return path.toString()


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table written by a plan."""
    return f"{_session_folder(shared_folder(spark), spark.sparkContext.applicationId)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    Cuts the lineage like a checkpoint: later steps see the same rows, and a lost executor costs no more than
    the step at hand. Being a table it is also compressed, read by column, and of known size, so the
    planner broadcasts it only if it is small.
    """
    path = scratch_table(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@cache
def _shipped(application: str) -> None:
    """Sends the package to the executors, once per application; in local mode they share the driver's path, where it may be."""
    root = Path(__file__).resolve().parents[1]
    seen = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    local = SparkSession.active().sparkContext.master.startswith("local") and "cluster" not in SparkSession.active().sparkContext.master
    if local and (root in seen or root == Path.cwd().resolve()):
        return
    folder = tempfile.mkdtemp(prefix="tillworks-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "tillworks.zip"
    with zipfile.ZipFile(archive, "w") as zipped:
        for file in sorted((root / "tillworks").rglob("*.py")):
            zipped.write(file, file.relative_to(root))
    SparkSession.active().sparkContext.addPyFile(str(archive))


def mapped(rows: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``rows.mapInArrow``, with this package at hand where the function runs."""
    _shipped(rows.sparkSession.sparkContext.applicationId)
    return rows.mapInArrow(function, schema)
