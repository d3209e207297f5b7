"""Scoring and export of streams: the batch operators on a streaming table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from featherline.sources import recordio
from featherline.sources.export import lean_features


def score_stream(model: Any, stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", **trigger: Any) -> StreamingQuery:
    """Append predictions to a stream and write it out; each input row is written exactly once."""
    writer = model.transform(stream).writeStream.format(fmt).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def write_records(stream: DataFrame, path: str, checkpoint: str, options: dict[str, str] | None = None,
                  **trigger: Any) -> StreamingQuery:
    """Write a stream of feature rows as framed records; a replayed batch replaces its files."""
    recordio.register(stream.sparkSession)
    writer = lean_features(stream, options or {}).writeStream.format("recordio").options(**(options or {}), path=path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
