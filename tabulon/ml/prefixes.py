"""Scores of an ensemble's first trees: one long fit stands for every shorter one.

The first m trees of a boosted model are the model of m rounds, as each round only
builds on those before it. The first m trees of a forest are a forest of m trees. So a
search over ensemble sizes fits the longest and reads the others off it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.session import scratch_path


def leaf_values(model, spark) -> list[np.ndarray]:
    """What each leaf of each tree adds to the positive class, leaves from left to right.

    A boosted tree adds its prediction times its weight, a forest's tree the share of positive rows in the leaf.
    Read from the stored form of the model, whose nodes are numbered in the order in which Spark numbers leaves.
    As large as the model, which Spark keeps on the driver anyway.
    """
    path = scratch_path(spark, "ensemble")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").filter("nodeData.leftChild < 0")
    stats = F.col("nodeData.impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda t, x: t + x)
    boosted = hasattr(model, "treeWeights") and type(model).__name__.startswith("GBT")
    value = F.col("nodeData.prediction") if boosted else F.coalesce(F.try_divide(stats[1], total), F.lit(0.0))
    leaves = nodes.select("treeID", F.col("nodeData.id").alias("id"), value.alias("value")).toPandas().sort_values(["treeID", "id"])
    weights = model.treeWeights if boosted else [1.0] * model.getNumTrees
    return [weights[t] * g["value"].to_numpy() for t, g in leaves.groupby("treeID", sort=True)]


def prefix_scores(model, rows: DataFrame, sizes: Sequence[int], label: str = "label") -> DataFrame:
    """(``label``, ``size``, ``score``): how each of the first ``sizes`` trees' ensembles ranks each row.

    For boosted trees the score is the margin, for forests the mean share of the positive class.
    """
    spark = rows.sparkSession
    values = leaf_values(model, spark)
    flat = np.concatenate(values)
    first = np.cumsum([0, *[len(v) for v in values[:-1]]])
    held = spark.sparkContext.broadcast((flat, first))  # as large as the model itself
    forest = not type(model).__name__.startswith("GBT")
    ends = np.array(sizes)

    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        flat, first = held.value
        for leaves in frames:
            if not len(leaves):
                yield pd.Series([], dtype=object)
                continue
            at = np.stack(leaves.to_numpy()).astype(np.int64) + first
            sums = np.cumsum(flat[at], axis=1)[:, ends - 1]
            yield pd.Series(list(sums / ends if forest else sums))

    scored = F.pandas_udf(run, T.ArrayType(T.DoubleType()))
    marked = model.copy().setLeafCol("_leaf").transform(rows).select(label, scored(vector_to_array("_leaf")).alias("_s"))
    pairs = F.arrays_zip(F.array(*[F.lit(int(s)) for s in sizes]).alias("size"), F.col("_s").alias("score"))
    return marked.select(label, F.inline(pairs)).toDF(label, "size", "score")
