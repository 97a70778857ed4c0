"""Preparation, training, tuning, evaluation and scoring on pyspark.ml."""

from tabulon.ml.evaluate import ClassificationMetrics, evaluate_model
from tabulon.ml.models import InverseStrengthLogisticRegression, build_model, default_classifier
from tabulon.ml.prepare import TabularPreparer
from tabulon.ml.score import load_model, save_model, score
from tabulon.ml.substitutes import SubstituteIndex, fit_substitutes, nearest_substitutes
from tabulon.ml.tune import FAMILIES, Trial, best_trials, refit, search, trials_table

__all__ = [
    "ClassificationMetrics", "FAMILIES", "InverseStrengthLogisticRegression", "SubstituteIndex", "TabularPreparer", "Trial",
    "best_trials", "build_model", "default_classifier", "evaluate_model", "fit_substitutes", "load_model", "nearest_substitutes",
    "refit", "save_model", "score", "search", "trials_table",
]
