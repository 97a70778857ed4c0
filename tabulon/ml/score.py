"""Saving, loading and applying fitted pipelines; batch and streaming rows alike."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: decisions are positive from this probability on.
DECISION_THRESHOLD = 0.5


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, data: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Input columns plus ``score_probability`` and ``score_predicted``."""
    kept = data.columns
    out = model.transform(data).withColumn("_p", vector_to_array("probability")[1])
    return out.select(*[f"`{c}`" for c in kept], F.col("_p").alias("score_probability")).withColumn(
        "score_predicted", F.col("score_probability") >= threshold
    )
