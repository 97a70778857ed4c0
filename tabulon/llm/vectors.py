"""What exact and approximate search share: valid vectors, blocks of rows, pairing blocks, merging top lists."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def valid_vectors(table: DataFrame, nonzero: bool) -> DataFrame:
    """Distinct (``vec_id``, ``vector`` of doubles, ``dim``) of the rows that take part.

    Left out are rows whose id or vector is null, or that hold a null or
    non-finite component, and zero vectors if ``nonzero``. Equal rows are one.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = table.filter("vec_id is not null and embedding is not null").filter(good)
    if nonzero:
        rows = rows.filter(F.exists(v, lambda x: x != 0))
    # -0.0 and 0.0 are equal numbers.
    return rows.select("vec_id", F.transform(v, lambda x: x + F.lit(0.0)).alias("vector"), F.size("embedding").alias("dim")).distinct()


def in_blocks(rows: DataFrame, name: str, n_blocks: int) -> DataFrame:
    """Deal rows to blocks by a hash of the whole row, so that repeated ids spread too."""
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_blocks)).cast("int"))


def n_blocks(count: int, rows_per_block: int) -> int:
    return max(1, math.ceil(count / rows_per_block))


def against_all(rows: DataFrame, other: str, blocks: int) -> DataFrame:
    """A copy of each row for each block of the other side."""
    return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def matrix(table: pa.Table, dim: int) -> np.ndarray:
    flat = table["vector"].combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks) if flat.num_chunks else pa.array([], flat.type)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, dim)


def merged(lists: DataFrame, k: int, best_first: str, levels: int, fan_in: int = 16) -> DataFrame:
    """Merge partial lists (``query_id``, ``part``, ``vec_id``, ``score``) by a tree to the k best of each query.

    Each level joins the lists of ``fan_in`` neighbouring parts, so no task ever
    gathers all parts of a query. ``rank`` starts from 1; ties go to the smaller id.
    """
    order = [F.col("score").desc() if best_first == "high" else F.col("score"), F.col("vec_id")]
    for _ in range(max(1, levels)):
        lists = lists.withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
        rank = F.row_number().over(W.partitionBy("query_id", "part").orderBy(*order))
        lists = lists.withColumn("rank", rank).filter(F.col("rank") <= k)
    return lists.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def tree_levels(parts: int, fan_in: int = 16) -> int:
    levels, reach = 1, fan_in
    while reach < parts:
        levels, reach = levels + 1, reach * fan_in
    return levels
