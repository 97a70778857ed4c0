"""Streams over arriving files.

Each query processes what is new and stops (``availableNow``), so a scheduled run
behaves like an incremental batch; its checkpoint remembers finished files.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabulon.ml.score import score


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, format: str = "parquet",
    glob: str | None = None, files_per_batch: int | None = None, bytes_per_batch: int | None = None,
) -> DataFrame:
    """Rows of every file that appears in the folder, each file once.

    A micro-batch takes files up to ``files_per_batch`` or ``bytes_per_batch``, or all that are there.
    """
    if files_per_batch and bytes_per_batch:
        raise ValueError("Bound a batch by files or by bytes, not by both")
    reader = spark.readStream.format(format).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(folder)


def ingest_new_files(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append new rows to a Parquet table, exactly once per file."""
    return (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def score_stream(stream: DataFrame, model: PipelineModel, target: str, checkpoint: str) -> StreamingQuery:
    """Score arriving rows with a fitted model; stateless."""
    return ingest_new_files(score(model, stream), target, checkpoint)
