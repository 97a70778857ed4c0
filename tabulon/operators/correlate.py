"""Pearson correlation over pairwise-complete rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.describe import column_means, numeric_columns
from tabulon.operators.quantiles import number

_SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]
# Below this share of the raw sum a variance is rounding noise: the column is constant.
_FLAT = 1e-12


def _co_sums(left: list[str], right: list[str]):
    """Per task: sums over rows where both columns are present, for every left x right pair."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, len(left), len(right)))
        for batch in batches:
            a, b = batch[left].to_numpy(float), batch[right].to_numpy(float)
            ma, mb = (~np.isnan(a)).astype(float), (~np.isnan(b)).astype(float)
            a, b = np.nan_to_num(a), np.nan_to_num(b)
            total += np.stack([ma.T @ mb, a.T @ mb, ma.T @ b, (a * a).T @ mb, ma.T @ (b * b), a.T @ b])
        i, j = np.indices(total.shape[1:])
        yield pd.DataFrame(
            {"i": i.ravel(), "j": j.ravel(), **{s: total[k].ravel() for k, s in enumerate(_SUMS)}}
        )

    return run


def _correlate(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """(x, y, r) for every left x right pair; null where a side is constant or rows are too few.

    Each task reduces its rows to one small matrix of sums around the column means;
    only those matrices are shuffled.
    """
    columns = list(dict.fromkeys([*left, *right]))
    measured = df.select(*[number(c).alias(c) for c in columns]).withColumn("_means", column_means(df, columns))
    centred = measured.select(*[(F.col(f"`{c}`") - F.col("_means")[F.lit(c)]).alias(c) for c in columns])
    schema = "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS)
    sums = centred.mapInPandas(_co_sums(left, right), schema).groupBy("i", "j").agg(
        *[F.sum(s).alias(s) for s in _SUMS]
    )
    n, sx, sy, sxx, syy, sxy = (F.col(s) for s in _SUMS)
    n = F.nullif(n, F.lit(0.0))
    vx, vy = sxx - sx * sx / n, syy - sy * sy / n
    r = F.when(
        (n > 1) & (vx > sxx * _FLAT) & (vy > syy * _FLAT),
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(sxy - sx * sy / n, F.sqrt(vx) * F.sqrt(vy)))),
    )
    return sums.select(
        F.get(F.array(*map(F.lit, left)), F.col("i")).alias("x"),
        F.get(F.array(*map(F.lit, right)), F.col("j")).alias("y"),
        r.alias("r"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The full symmetric matrix in long form (x, y, r)."""
    columns = list(columns or numeric_columns(df))
    return _correlate(df, columns, columns)


def correlation_with(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every other column's correlation with the target, strongest positive first."""
    others = [c for c in (columns or numeric_columns(df)) if c != target]
    return _correlate(df, others, [target]).select(F.col("x").alias("column"), "r").orderBy(
        F.col("r").desc_nulls_last(), "column"
    )
