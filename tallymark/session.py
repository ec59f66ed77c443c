"""Session helpers: shipping this package to executors and finding the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add this package as a py-file once per application, so that executors can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tallymark-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def ship_active() -> None:
    """Ship the package in the active session, if there is one: for functions that make a column, not a frame."""
    session = SparkSession.getActiveSession()
    if session is not None:
        ship_package(session)


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the context's checkpoint folder, as a URI.

    Where neither is set, a temporary one serves a local session, whose driver is its only executor;
    elsewhere that is an error, as executors would not see it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or _ROOTS.get(context.applicationId)
    if not root:
        found = context._jsc.sc().getCheckpointDir()
        if found.isDefined():
            root = found.get()
        elif context.master.split("[")[0] == "local":
            root = tempfile.mkdtemp(prefix="tallymark-shared-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        _ROOTS[context.applicationId] = root
    return root if "://" in root or root.startswith("file:") else f"file://{root}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, name: str, compression: str = "snappy", path: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it again: cuts lineage and survives lost executors."""
    spark = frame.sparkSession
    path = path or shared_path(spark, name)
    frame.write.option("compression", compression).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unstaged(spark: SparkSession, path: str) -> None:
    """Delete a staged table that no frame in use reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
