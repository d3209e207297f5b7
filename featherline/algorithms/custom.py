"""A user's own algorithm under the same contracts: a fit function and a codec pair with a scorer."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.cloudpickle import dumps, loads
from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, types as T

from featherline.algorithms.params import HyperParams
from featherline.operators import packing, tables


class CustomEstimator(Estimator, HyperParams):
    """``fit(df, hyperparameters)`` runs the user's Spark jobs and gives a scorer of payloads.

    The scorer maps the bytes of encoded rows to the bytes the decoder reads. It is sent to
    tasks, so it should hold no more than the fitted parameters.
    """

    def __init__(self, fit: Callable[[DataFrame, dict[str, str]], Callable[[bytes], bytes]], encoder: Any, decoder: Any,
                 hyperparameters: dict[str, str] | None = None, columns: list[str] | None = None, keep_input: bool = True,
                 max_bytes: int = packing.MAX_BYTES, max_records: int = packing.MAX_RECORDS) -> None:
        super().__init__()
        self.fit_function, self.encoder, self.decoder = fit, encoder, decoder
        self.base, self.columns, self.keep_input = dict(hyperparameters or {}), columns, keep_input
        self.bounds = (max_bytes, max_records)

    def hyperparameters(self, base: dict[str, str] | None = None) -> dict[str, str]:
        return super().hyperparameters({**self.base, **(base or {})})

    def _fit(self, df: DataFrame) -> CustomModel:
        scorer = self.fit_function(tables.project(df, self.columns), self.hyperparameters())
        return CustomModel(scorer, self.encoder, self.decoder, self.keep_input, *self.bounds)


class CustomModel(Model, MLReadable, MLWritable):
    """Encodes, packs, scores and decodes inside tasks, and appends the answers.

    It is saved as Spark sends functions to tasks, so whoever loads it needs the same libraries, and
    should trust the folder.
    """

    def __init__(self, scorer: Callable[[bytes], bytes], encoder: Any, decoder: Any, keep_input: bool = True,
                 max_bytes: int = packing.MAX_BYTES, max_records: int = packing.MAX_RECORDS) -> None:
        super().__init__()
        packing.require_bounds(max_bytes, max_records)
        self.scorer, self.encoder, self.decoder, self.keep_input = scorer, encoder, decoder, keep_input
        self.max_bytes, self.max_records = max_bytes, max_records

    def write(self) -> MLWriter:
        return _CustomWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CustomReader()

    def transformSchema(self, schema: T.StructType) -> T.StructType:
        self.encoder.validate(schema)
        return T.StructType([*(schema.fields if self.keep_input else []), *self.decoder.schema])

    def _transform(self, df: DataFrame) -> DataFrame:
        return packing.score_payloads(df, self.encoder, self.decoder, self.scorer, self.max_bytes, self.max_records,
                                      self.keep_input)


class _CustomWriter(MLWriter):
    def __init__(self, model: CustomModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark)
        parts = dumps((m.scorer, m.encoder, m.decoder, m.keep_input, m.max_bytes, m.max_records))
        spark.createDataFrame([(parts,)], "parts binary").coalesce(1).write.parquet(f"{path}/parts")


class _CustomReader(MLReader):
    def load(self, path: str) -> CustomModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = CustomModel(*loads(bytes(spark.read.parquet(f"{path}/parts").first()["parts"])))
        model._resetUid(metadata["uid"])
        return model
