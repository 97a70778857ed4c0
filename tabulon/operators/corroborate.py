"""Agreement between repeated readings kept as rows instead of arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corroborated_rows(
    df: DataFrame, group: str, candidate: str, position: str, min_len: int = 3
) -> DataFrame:
    """(group, picked): the reading most other readings of the group share a prefix with.

    Same rule as :func:`tabulon.functions.pick_corroborated` for groups of any size:
    readings are merged per prefix before they meet, so no group is ever collected
    and no pairs are formed. Groups without agreement, or without a usable reading,
    give null.
    """
    text = F.col(candidate)
    usable = F.length(text) >= min_len
    per_prefix = df.groupBy(group, F.when(usable, F.left(text, F.lit(min_len))).alias("_prefix")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(text, F.struct(F.length(text), -F.col(position))).alias("_text"),
        F.max(F.struct(F.length(text).alias("digits"), (-F.col(position)).alias("earlier"))).alias("_best"),
    )
    support = F.when(F.col("_prefix").isNotNull(), F.col("_n") - 1)
    rank = F.struct(support.alias("support"), F.col("_best"))
    best = per_prefix.groupBy(group).agg(
        F.max_by(F.struct(F.col("_text").alias("text"), support.alias("support")),
                 F.when(F.col("_prefix").isNotNull(), rank)).alias("b")
    )
    return best.select(group, F.when(F.col("b.support") >= 1, F.col("b.text")).alias("picked"))
