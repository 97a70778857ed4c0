"""Descriptive statistics, one row per numeric column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.operators.quantiles import number, place, resolve_quantiles, summarise, value_counts

QUARTILES = [0.25, 0.5, 0.75]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def column_means(df: DataFrame, columns: Sequence[str]) -> Column:
    """Map from column name to mean, as a scalar subquery."""
    pairs = [part for c in columns for part in (F.lit(c), F.avg(number(c)))]
    return df.agg(F.create_map(*pairs).alias("means")).scalar()


def moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, count, mean, std, min, max, skew, kurtosis, zero_pct.

    Skew and kurtosis are the bias-adjusted sample forms: null below three and four
    values, 0 for a constant column. A missing value is not a zero but stays in the
    denominator of ``zero_pct``. Power sums are taken around each column's mean and
    merge per task; columns are stacked so the aggregation stays narrow at any width.
    """
    columns = list(columns or numeric_columns(df))
    stacked = df.select(*[number(c).alias(c) for c in columns]).unpivot([], columns, "column", "value")
    shifted = stacked.select(
        "column", "value", (F.col("value") - column_means(df, columns)[F.col("column")]).alias("d")
    ).withColumn("d2", F.col("d") * F.col("d"))
    d, d2 = F.col("d"), F.col("d2")
    sums = shifted.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("count"),
        F.avg("d").alias("a1"), F.avg(d2).alias("a2"), F.avg(d2 * d).alias("a3"), F.avg(d2 * d2).alias("a4"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.col("value") == 0).alias("zeros"),
    ).withColumn("mean", F.col("a1") + column_means(df, columns)[F.col("column")])
    return _shape(sums)


def _shape(sums: DataFrame) -> DataFrame:
    """The columns of :func:`moments` from means ``a1`` to ``a4`` of the powers of the centred values.

    Other columns of ``sums`` are kept behind them.
    """
    known = ["column", "rows", "count", "a1", "a2", "a3", "a4", "min", "max", "zeros", "mean"]
    n, a1, a2, a3, a4 = (F.col(c) for c in ("count", "a1", "a2", "a3", "a4"))
    constant = F.col("min") == F.col("max")
    m2 = F.when(constant, F.lit(0.0)).otherwise(a2 - a1 * a1)
    m3 = a3 - 3 * a1 * a2 + 2 * a1 * a1 * a1
    m4 = a4 - 4 * a1 * a3 + 6 * a1 * a1 * a2 - 3 * a1 * a1 * a1 * a1
    spread = sums.withColumns({"m2": m2, "m3": m3, "m4": m4})
    m2, m3, m4 = F.col("m2"), F.col("m3"), F.col("m4")
    g1 = F.coalesce(F.try_divide(m3, m2 * F.sqrt(m2)), F.lit(0.0))
    g2 = F.coalesce(F.try_divide(m4, m2 * m2) - 3, F.lit(0.0))
    nd = n.cast("double")
    skew = g1 * F.sqrt(nd * (nd - 1)) / F.nullif(nd - 2, F.lit(0.0))
    kurt = (nd - 1) / F.nullif((nd - 2) * (nd - 3), F.lit(0.0)) * ((nd + 1) * g2 + 6)
    return spread.select(
        "column", "count", "mean",
        F.when(n > 1, F.sqrt(m2 * nd / (nd - 1))).alias("std"),
        "min", "max",
        F.when(n > 2, skew).alias("skew"),
        F.when(n > 3, F.when(constant, F.lit(0.0)).otherwise(kurt)).alias("kurtosis"),
        (F.col("zeros") / F.col("rows") * 100).alias("zero_pct"),
        *[c for c in sums.columns if c not in known],
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max, mode, median, iqr, cv, skew, kurtosis, zero_pct.

    Two scans: the first sketches all columns at once, which gives counts, extremes
    and brackets; the second counts distinct values, from which power sums, quartiles
    and the mode (the smallest among equally frequent values) all follow. A column
    without values has a row of count 0; an empty table has no rows.
    """
    columns = list(columns or numeric_columns(df))
    # Powers are taken around a value near the median: at most about one standard deviation off the mean.
    summary = summarise(df, columns, QUARTILES).withColumn("centre", F.col("lo")[1])
    placed = place(value_counts(df, columns), summary, QUARTILES)
    v, w = F.col("value"), F.col("weight")
    d = v - F.col("centre")
    powers = {"s1": d * w, "s2": d * d * w, "s3": d * d * d * w, "s4": d * d * d * d * w}
    # Equal frequencies first, so that the bulk meets in plain sums and a minimum.
    tally = placed.groupBy("column", "n", "band", "slot", "weight").agg(
        F.sum(w).alias("all"), F.min("value").alias("least"), F.sum(F.when(v == 0, w)).alias("zeros"),
        *[F.sum(x).alias(name) for name, x in powers.items()],
    )
    slots = tally.groupBy("column", "n", "band", "slot").agg(
        F.max(F.struct("weight", (-F.col("least")).alias("negative"))).alias("top"),
        F.sum("all").alias("weight"), F.sum("zeros").alias("zeros"), *[F.sum(s).alias(s) for s in powers],
    )
    quartiles = resolve_quantiles(placed, slots.select("column", "n", "band", "slot", "weight"), QUARTILES)
    sums = slots.groupBy("column").agg(
        *[(F.sum(f"s{k}") / F.first("n")).alias(f"a{k}") for k in (1, 2, 3, 4)],
        (-F.max("top")["negative"]).alias("mode"), F.sum("zeros").alias("zeros"),
    )
    # Every side has one row per column, so broadcasting them is bounded by the schema.
    joined = (
        summary.select("column", "rows", F.col("n").alias("count"), "centre", "min", "max")
        .join(F.broadcast(sums), "column", "left")
        .join(F.broadcast(quartiles.select("column", "q")), "column", "left")
        .withColumns({"mean": F.col("centre") + F.col("a1"), "zeros": F.coalesce("zeros", F.lit(0))})
        .drop("centre")
    )
    q = F.col("q")
    return _shape(joined).select(
        "column", "count", "mean", "mode", "std", "min",
        q[0].alias("p25"), q[1].alias("median"), q[2].alias("p75"), "max",
        (q[2] - q[0]).alias("iqr"), F.try_divide("std", "mean").alias("cv"),
        "skew", "kurtosis", "zero_pct",
    )
