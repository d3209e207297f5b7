"""What all estimators and models share: checks, export on fit, prediction columns, persistence."""

from __future__ import annotations

import uuid
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.param import TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from featherline.algorithms.params import HyperParams, declare, text
from featherline.operators import tables
from featherline.sources import export, files, recordio
from featherline.functions.keys import OWNING_DELIMITERS



class Wired(HyperParams):
    featuresCol = declare("featuresCol", "vector column", text)
    labelCol = declare("labelCol", "double column to learn from", text)
    keepInput = declare("keepInput", "whether predictions are appended to the input columns", TypeConverters.toBoolean)


class TableEstimator(Estimator, Wired, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator over a feature table.

    With ``exportPath`` the training columns are first written there, as the other tools that
    train on files would get them, and training reads the written table: its many passes then start
    from files and not from the caller's query. The export is removed afterwards unless ``keepExport``.
    """

    labeled = False

    trainingColumns = declare("trainingColumns", "columns to train on and export; all when empty", TypeConverters.toListString)
    exportPath = declare("exportPath", "where to write the training table first", text)
    exportFormat = declare("exportFormat", "format of the export: recordio, libsvm or parquet", text)
    checkRows = declare("checkRows", "whether all rows are checked before training", TypeConverters.toBoolean)
    keepExport = declare("keepExport", "whether the export stays after training", TypeConverters.toBoolean)

    def __init__(self, **params: Any) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", keepInput=True, exportFormat="recordio", keepExport=False,
                         checkRows=True)
        self._preset()
        self._set(**params)

    def _preset(self) -> None:
        """Defaults of a subclass."""

    def transformSchema(self, schema: T.StructType) -> T.StructType:
        self.require_params()
        tables.require_columns(schema, self.getOrDefault("featuresCol"),
                               self.getOrDefault("labelCol") if self.labeled else None)
        return schema

    def _train(self, df: DataFrame) -> TableModel:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> TableModel:
        if self.isDefined("trainingColumns"):
            df = tables.project(df, self.getOrDefault("trainingColumns"))
        self.transformSchema(df.schema)
        if self.getOrDefault("checkRows"):
            self._check_rows(df)
        path = self.getOrDefault("exportPath") if self.isDefined("exportPath") else None
        if path is None:
            model = self._train(df)
        else:
            try:
                model = self._train(self._exported(df, path))
            finally:
                if not self.getOrDefault("keepExport"):
                    remove_export(path)
        model._set(featuresCol=self.getOrDefault("featuresCol"), keepInput=self.getOrDefault("keepInput"))
        return model

    def _check_rows(self, df: DataFrame) -> None:
        """Every vector must have ``feature_dim`` entries, where that is given."""
        if not self.hasParam("feature_dim") or not self.isDefined("feature_dim"):
            return
        features, width = self.getOrDefault("featuresCol"), self.getOrDefault("feature_dim")
        label = self.getOrDefault("labelCol") if self.labeled else None
        tables.require_valid(df, features=features, label=label, feature_dim=width, num_classes=self._classes())

    def _classes(self) -> int | None:
        return None

    def _exported(self, df: DataFrame, path: str) -> DataFrame:
        fmt, features = self.getOrDefault("exportFormat"), self.getOrDefault("featuresCol")
        label = self.getOrDefault("labelCol") if self.labeled else None
        spark = df.sparkSession
        if fmt == "recordio":
            recordio.register(spark)
            options = {"featuresColumnName": features, **({"labelColumnName": label} if label else {})}
            slim = df.select(*([label] if label else []), features)
            export.export(slim, path, fmt, options)
            return spark.read.format(fmt).options(**options).load(path)
        if fmt == "libsvm":
            export.write_libsvm(df if label else df.withColumn("label", F.lit(0.0)), path, label or "label", features)
            back = spark.read.format(fmt)
            if self.hasParam("feature_dim") and self.isDefined("feature_dim"):
                back = back.option("numFeatures", str(self.getOrDefault("feature_dim")))
            return back.load(path).withColumnsRenamed({"label": label or "label", "features": features})
        export.export(df, path, fmt)
        return spark.read.format(fmt).load(path)


def remove_export(path: str) -> None:
    """Delete an export and what belongs to it: its files, manifest and folder markers, nothing that
    merely shares its name's beginning."""
    store, inner = files.open_store(path)
    info = store.get_file_info(inner)
    if info.type.name == "Directory":
        store.delete_dir(inner)
    for delimiter in OWNING_DELIMITERS[1:]:
        for suffix in (export.MANIFEST_SUFFIX, "_$folder$"):
            beside = inner + suffix
            if suffix.startswith(delimiter) and store.get_file_info(beside).type.name == "File":
                store.delete_file(beside)


class TableModel(Model, Wired, MLReadable, MLWritable):
    """A fitted model: Spark ML stages, number arrays and facts, all saved together.

    ``predict`` gives the table with whatever helper columns it needs, and the prediction columns.
    """

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", keepInput=True)
        self.stages: dict[str, Any] = {}
        self.arrays: dict[str, np.ndarray] = {}
        self.facts: dict[str, Any] = {}

    def outputs(self) -> dict[str, T.DataType]:
        raise NotImplementedError

    def predict(self, df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
        raise NotImplementedError

    def transformSchema(self, schema: T.StructType) -> T.StructType:
        tables.require_columns(schema, self.getOrDefault("featuresCol"))
        kept = [f for f in schema if f.name not in self.outputs()] if self.getOrDefault("keepInput") else []
        return T.StructType([*kept, *[T.StructField(n, t) for n, t in self.outputs().items()]])

    def _transform(self, df: DataFrame) -> DataFrame:
        tables.require_columns(df.schema, self.getOrDefault("featuresCol"))
        scored, columns = self.predict(df)
        kept = [c for c in df.columns if c not in columns] if self.getOrDefault("keepInput") else []
        return scored.select(*kept, *[column.alias(name) for name, column in columns.items()])

    def write(self) -> MLWriter:
        return _TableModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableModelReader(cls)


class _TableModelWriter(MLWriter):
    def __init__(self, model: TableModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.sparkSession
        extra = {"facts": model.facts, "stageNames": list(model.stages), "arrayNames": list(model.arrays)}
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata=extra)
        for name, stage in model.stages.items():
            stage.write().save(f"{path}/stages/{name}")
        for name, array in model.arrays.items():
            rows = pa.table({"position": pa.array(range(len(array)), pa.int64()),
                             "numbers": pa.array(list(np.asarray(array, float)), pa.list_(pa.float64()))})
            spark.createDataFrame(rows).write.parquet(f"{path}/arrays/{name}")


class _TableModelReader(MLReader):
    def __init__(self, cls: type[TableModel]) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.facts = metadata["facts"]
        for name in metadata["stageNames"]:
            model.stages[name] = DefaultParamsReader.loadParamsInstance(f"{path}/stages/{name}", spark)
        for name in metadata["arrayNames"]:
            rows = spark.read.parquet(f"{path}/arrays/{name}").orderBy("position").toArrow()
            model.arrays[name] = np.array(rows.column("numbers").to_pylist(), float)
        return model


def attach(spark: SparkSession, path: str) -> Any:
    """A saved model, of whichever class it was saved as."""
    return DefaultParamsReader.loadParamsInstance(path, spark)


def scratch_name(stem: str) -> str:
    return f"_{stem}_{uuid.uuid4().hex[:8]}"


