"""Equal-width histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BINS = 45


def histogram(df: DataFrame, column: str, bins: int = DEFAULT_BINS) -> DataFrame:
    """(bin, lower, upper, n) over min..max; the last bin is closed and empty bins are kept.

    A constant column spans half a unit on both sides. Values on a computed edge
    belong to the bin that starts there, whatever rounding says.
    """
    x = F.col(f"`{column}`").cast("double")
    present = df.select(F.when(~F.isnan(x), x).alias("x")).filter(F.col("x").isNotNull())
    ends = present.agg(F.min("x").alias("a"), F.max("x").alias("b"))
    flat = F.col("a") == F.col("b")
    span = ends.select(F.struct(
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
    )).scalar()
    s = F.col("_span")
    width = (s["hi"] - s["lo"]) / F.lit(float(bins))

    def edge(i):
        return s["lo"] + i * width

    guess = F.least(F.floor((F.col("x") - s["lo"]) / (s["hi"] - s["lo"]) * bins), F.lit(bins - 1))
    placed = (
        present.withColumn("_span", span).withColumn("g", guess)
        .select((
            F.col("g")
            - F.when((F.col("x") < edge(F.col("g"))) & (F.col("g") > 0), 1).otherwise(0)
            + F.when((F.col("x") >= edge(F.col("g") + 1)) & (F.col("g") < bins - 1), 1).otherwise(0)
        ).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(placed, "bin", "left").withColumn("_span", span).select(
        "bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )
