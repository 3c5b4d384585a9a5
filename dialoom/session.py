"""Session settings and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine relies on. AQE re-plans joins, splits skewed
#: partitions and coalesces small ones; timestamps are read as UTC.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "dialoom", master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the engine's settings; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (ENGINE_CONF | (extra or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough where workers see the same folder; elsewhere the package is
    installed on the workers or passed with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's.

    Only a session whose one process is driver and executor at once (master
    ``local``) may do without; it gets a folder of its own, removed at exit.
    On a cluster a missing setting is an error, as a machine-local folder would
    scatter the tables.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder; set it to one that all executors share")
        folder = tempfile.mkdtemp(prefix="dialoom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its name says; gone is fine."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Folders written by this process and not yet released: path -> session.
_written: dict[str, SparkSession] = {}


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage durably: the written table survives the loss of any
    executor, unlike a local checkpoint. Rounds of an iteration ``release`` the
    state before; what a result still reads lasts until the ``scratch`` block
    around it ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._dialoom_folder = path
    return out


def release(df: DataFrame) -> None:
    """Delete the folder of a materialised table that nothing reads any more."""
    path = getattr(df, "_dialoom_folder", None)
    if path is not None and _written.pop(path, None) is not None:
        remove_folder(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end every table materialised within.

    Results must be written, or collected, inside the block.
    """
    before = set(_written)
    try:
        yield
    finally:
        for path in set(_written) - before:
            del _written[path]
            remove_folder(spark, path)
