"""Batch labelling and scoring applied to a stream of files.

A fitted pipeline and the row-wise text labellers need no state, so the same transformation runs on
a streaming frame. Fits, curves and neighbour joins stay batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def start_labelling(
    rows: DataFrame, transform: Callable[[DataFrame], DataFrame], sink: str, progress: str, once: bool = True
) -> StreamingQuery:
    """Write ``transform(rows)`` to ``sink``; ``progress`` is the stream's checkpoint folder."""
    writer = transform(rows).writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress)
    return (writer.trigger(availableNow=True) if once else writer).start(sink)
