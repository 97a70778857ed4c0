"""Held-out evaluation of a fitted model."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.metrics import evaluate


@dataclass(frozen=True)
class ClassificationMetrics:
    accuracy: float
    precision: float
    recall: float
    f1: float
    roc_auc: float

    def as_dict(self) -> dict[str, float]:
        return asdict(self)

    def __str__(self) -> str:
        return " ".join(f"{name}={value:.4f}" for name, value in asdict(self).items())


def scored_rows(model, data: DataFrame, label: str = "label") -> DataFrame:
    """(label, prediction, score): hard decision and positive-class probability."""
    out = model.transform(data)
    return out.select(
        F.col(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def metrics_table(model, data: DataFrame, label: str = "label") -> DataFrame:
    """The five metrics as a one-row table."""
    return evaluate(scored_rows(model, data, label))


def evaluate_model(model, data: DataFrame, label: str = "label") -> ClassificationMetrics:
    row = metrics_table(model, data, label).first()
    return ClassificationMetrics(**row.asDict())
