"""Training-set export in any Spark format, and the manifest of what was written."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F

from featherline.functions import keys, vectors
from featherline.operators.tables import project
from featherline.sources import files

MANIFEST_SUFFIX = ".manifest.txt"
# Ways to lay out an export for its readers (fixed values).
SHARDED = "sharded"
REPLICATED = "replicated"


def export(df: DataFrame, path: str, fmt: str = "recordio", options: Mapping[str, str] | None = None,
           columns: Sequence[str] | None = None, shards: int | None = None, distribution: str = SHARDED,
           mode: str | None = None) -> None:
    """Write a training set without a success marker.

    ``columns`` projects first. With ``shards``, the sharded layout writes that many near-equal
    partitions for workers to divide between them; the replicated layout is one data set that
    every worker reads whole, so its partitioning is left alone. Like Spark, the write fails if
    the path exists, unless ``mode`` says otherwise.
    """
    if distribution not in (SHARDED, REPLICATED):
        raise ValueError(f"unknown distribution {distribution}")
    chosen = project(df, columns)
    if fmt == "recordio":
        chosen = lean_features(chosen, dict(options or {}))
    if shards and distribution == SHARDED:
        chosen = chosen.repartition(shards)
    if fmt == "recordio" and mode is None:
        # Data sources written in Python know append and overwrite only.
        if exists(path):
            raise FileExistsError(path)
        mode = "append"
    writer = chosen.write.format(fmt).options(**dict(options or {}))
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    (writer.mode(mode) if mode else writer).save(path)


def lean_features(df: DataFrame, options: Mapping[str, str]) -> DataFrame:
    """The features column in the form that reaches tasks fastest."""
    name = options.get("featuresColumnName", "features")
    if name in df.columns and isinstance(df.schema[name].dataType, VectorUDT):
        return df.withColumn(name, vectors.lean(F.col(name)))
    return df


def exists(path: str) -> bool:
    store, inner = files.open_store(path)
    return store.get_file_info(inner).type.name != "NotFound"


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    """LibSVM text with Spark's own sink, which takes exactly a label and a vector."""
    export(df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features")), path, "libsvm")


def read_libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    return spark.read.format("libsvm").option("numFeatures", str(num_features)).load(path)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """``name, length, path`` of the data files below ``path``; their contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", "path")
    )
    return found.filter(~keys.is_marker(F.col("name")))


def write_manifest(spark: SparkSession, path: str, prefix: str | None = None) -> str:
    """List an export as JSON beside it: the prefix, then every file name. Returns the manifest's path.

    Names arrive one partition at a time and go straight to the file.
    """
    target = path.rstrip("/") + MANIFEST_SUFFIX
    store, inner = files.open_store(target)
    names = listing(spark, path).select("name").orderBy("name")
    with store.open_output_stream(inner, compression=None) as out:
        out.write(b"[" + json.dumps({"prefix": (prefix or path).rstrip("/") + "/"}).encode())
        count = 0
        for row in names.toLocalIterator():
            out.write(b", " + json.dumps(row["name"]).encode())
            count += 1
        if not count:
            raise ValueError(f"no data files found at {path}")
        out.write(b"]")
    return target
