"""Classifiers and the model pipeline around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tabulon.ml.prepare import TabularPreparer
from tabulon.schemas import CHURN_CATEGORICAL, CHURN_NUMERIC

#: The calibrated default model.
DEFAULT_STEP, DEFAULT_DEPTH, DEFAULT_TREES, DEFAULT_SEED = 0.1, 2, 100, 42


def default_classifier() -> GBTClassifier:
    return GBTClassifier(
        stepSize=DEFAULT_STEP, maxDepth=DEFAULT_DEPTH, maxIter=DEFAULT_TREES, seed=DEFAULT_SEED,
        labelCol="label", featuresCol="features",
    )


class InverseStrengthLogisticRegression(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Ridge logistic regression set by C, the inverse penalty on the summed loss.

    Spark penalises the mean loss, so the strength depends on the rows fitted and
    is worked out at fit time: regParam = 1 / (C * n).
    """

    C = Param(Params._dummy(), "C", "inverse regularisation strength", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    def __init__(self, C=1.0, maxIter=1000):
        super().__init__()
        self._set(C=C, maxIter=maxIter)

    def _fit(self, dataset: DataFrame):
        rows = dataset.count()
        return LogisticRegression(
            regParam=1.0 / (self.getOrDefault(self.C) * max(rows, 1)), elasticNetParam=0.0,
            standardization=False, maxIter=self.getOrDefault(self.maxIter), labelCol="label", featuresCol="features",
        ).fit(dataset)


def build_model(
    classifier: Estimator | None = None,
    numeric: Sequence[str] = CHURN_NUMERIC,
    categorical: Sequence[str] = CHURN_CATEGORICAL,
) -> Pipeline:
    """Preparation and classifier as one pipeline, fitted together on training rows."""
    return Pipeline(stages=[TabularPreparer(numeric, categorical), classifier or default_classifier()])
