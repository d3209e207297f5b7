"""Where jobs keep written intermediate tables, and how tasks get this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder that driver and executors all reach: the session's checkpoint folder.

    A temporary folder is used only for a local master, where every task runs on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if root:
        # A path without a scheme means the default file system, for Spark and for Arrow alike.
        default = context._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        plain = ":" not in root.split("/")[0] and not default.startswith("file:")
        return (default.rstrip("/") + root if plain else root).rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="featherline-")
    return _LOCAL_ROOT[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/featherline/{app}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later jobs start from files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete what was written at ``path``, once nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def ship_package(spark: SparkSession) -> None:
    """Give tasks this package, once per application, the way ``--py-files`` does."""
    context = spark.sparkContext
    if getattr(context, "_featherline_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="featherline-"), "featherline.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, files in os.walk(package):
            for file in sorted(files):
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    context._featherline_shipped = True
