"""Data-quality counts and category balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.coerce import to_number
from tabulon.operators.describe import numeric_columns


def _row_identity(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Grouping columns equal exactly when the rows are; long text goes in as a SHA-256 digest of all of it."""
    types = {f.name: f.dataType for f in df.schema}
    out = []
    for c in columns:
        col = F.col(f"`{c}`")
        out.append((F.unhex(F.sha2(col, 256)) if isinstance(types[c], T.StringType) else col).alias(f"k_{c}"))
    return out


def surplus_rows(df: DataFrame, columns: Sequence[str] | None = None, name: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each group of equals; missing values equal each other.

    Groups are pre-counted map-side, so a hot group costs one row per task.
    """
    columns = list(columns or df.columns)
    groups = df.groupBy(*_row_identity(df, columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias(name))


def missing_cells(df: DataFrame) -> Column:
    """Aggregate: missing cells over all columns, NaN included."""
    total = F.lit(0)
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        absent = c.isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            absent = absent | F.coalesce(F.isnan(c), F.lit(False))
        total = total + absent.cast("int")
    return F.coalesce(F.sum(total), F.lit(0)).cast("bigint")


def unparsable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column, how many values (missing ones included) are no number."""
    return df.agg(*[F.count_if(to_number(F.col(f"`{c}`")).isNull()).alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "invalid"
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Each value once, null included."""
    return df.select(column).distinct()


def type_breakdown(df: DataFrame) -> DataFrame:
    """How many columns of each type: schema only, no scan."""
    tally: dict[str, int] = {}
    for _, type_ in df.dtypes:
        tally[type_] = tally.get(type_, 0) + 1
    return df.sparkSession.createDataFrame(sorted(tally.items()), "type string, columns bigint")


def quality_report(df: DataFrame, key: str) -> DataFrame:
    """One row: size, column kinds, missing cells, duplicate keys and duplicate rows."""
    numeric = len(numeric_columns(df))
    one_pass = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(numeric).cast("bigint").alias("n_numeric"),
        F.lit(len(df.columns) - numeric).cast("bigint").alias("n_other"),
        missing_cells(df).alias("missing_cells"),
    )
    return one_pass.withColumns({
        "duplicate_keys": surplus_rows(df, [key]).scalar(),
        "duplicate_rows": surplus_rows(df).scalar(),
    })


def value_balance(df: DataFrame, column: str, categories: Sequence) -> DataFrame:
    """Count and percent of each listed category.

    A listed category without rows gets nulls; unlisted values count nowhere.
    """
    listed = df.filter(F.col(column).isin(list(categories)))
    counts = listed.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = listed.agg(F.count(F.lit(1)).alias("n")).scalar()
    names = df.sparkSession.createDataFrame(
        [(c,) for c in categories], T.StructType([T.StructField(column, df.schema[column].dataType)])
    )
    return names.join(counts, column, "left").withColumn("pct", F.try_divide(F.col("n") * 100.0, total))


def class_rate(df: DataFrame, group: str, label: str) -> DataFrame:
    """Share of positives per group."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"))
