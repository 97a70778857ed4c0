"""Nutrient table profile: quality, statistics, distribution, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tabulon.operators.correlate import correlation_matrix, correlation_with
from tabulon.operators.describe import describe, numeric_columns
from tabulon.operators.histogram import histogram
from tabulon.operators.quality import quality_report, type_breakdown
from tabulon.operators.select import drop_columns
from tabulon.schemas import FOOD_INDEX_COLUMNS, FOOD_NAME
from tabulon.sources.readers import read_csv

#: Columns the report singles out.
HISTOGRAM_COLUMN = "Caloric Value"
CORRELATION_TARGETS = ("Caloric Value", "Nutrition Density")


def read_food(spark: SparkSession, path: str, schema) -> DataFrame:
    """The nutrient table without its exported row numbers."""
    return read_csv(spark, path, schema, drop=FOOD_INDEX_COLUMNS)


def profile(
    df: DataFrame, key: str = FOOD_NAME, histogram_column: str = HISTOGRAM_COLUMN,
    targets: Sequence[str] = CORRELATION_TARGETS,
) -> dict[str, DataFrame]:
    """Every table of the report, by name; each is its own query."""
    df = drop_columns(df, FOOD_INDEX_COLUMNS)
    numeric = numeric_columns(df)
    return {
        "quality": quality_report(df, key),
        "types": type_breakdown(df),
        "statistics": describe(df, numeric),
        "histogram": histogram(df, histogram_column),
        "correlations": correlation_matrix(df, numeric),
        **{f"correlation with {t}": correlation_with(df, t, numeric) for t in targets},
    }
