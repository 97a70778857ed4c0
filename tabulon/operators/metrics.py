"""Binary classification metrics from (label, prediction, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.operators.ordering import CELL, ROWS_PER_CELL, cells_for, with_cell
from tabulon.session import scratch_path
from tabulon.sources.writers import write_layer


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts of all four (label, prediction) pairs, zeros included."""
    counts = df.agg(*[
        F.count_if((F.col(label) == a) & (F.col(prediction) == b)).alias(f"{a}{b}")
        for a in (0, 1) for b in (0, 1)
    ])
    cells = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"{a}{b}").alias("n"))
        for a in (0, 1) for b in (0, 1)
    ]
    return counts.select(F.inline(F.array(*cells)))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def threshold_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall and f1 of the positive class; an empty denominator gives 0."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    t = df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return t.select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """One row, ``roc_auc``: chance that a positive outscores a negative, ties counting half.

    Equal scores are merged first and stored; negatives below are then counted inside
    cells of the sorted scores, and across cells on their totals alone.
    """
    positive = F.count_if(F.col(label) == 1).alias("pos")
    negative = F.count_if(F.col(label) != 1).alias("neg")
    scores = df.groupBy(F.col(score).cast("double").alias("s")).agg(positive, negative)
    scores = write_layer(scores, scratch_path(df.sparkSession, "scores"))
    n = cells_for(scores, rows_per_cell)
    cells = with_cell(scores, n, ["s"]) if n > 1 else scores.withColumn(CELL, F.lit(0))
    below = W.partitionBy(CELL).orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    ranked = cells.withColumn("neg_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    won = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2)
    per_cell = ranked.groupBy(CELL).agg(
        F.sum(won).alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    # One row per cell from here: rows / rows_per_cell of them.
    earlier = W.orderBy(CELL).rowsBetween(W.unboundedPreceding, -1)
    totals = per_cell.withColumn("neg_before", F.coalesce(F.sum("neg").over(earlier), F.lit(0))).agg(
        F.sum(F.col("won") + F.col("pos").cast("double") * F.col("neg_before")).alias("won"),
        F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"),
    )
    return totals.select(F.try_divide(F.col("won"), F.col("pos") * F.col("neg")).alias("roc_auc"))


def evaluate(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """One row: accuracy, precision, recall, f1, roc_auc."""
    return threshold_metrics(df, label, prediction).withColumn("roc_auc", roc_auc(df, label, score).scalar())
