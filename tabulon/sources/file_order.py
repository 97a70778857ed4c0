"""The order in which rows were delivered: by file, by place in the file.

A row's place is taken where it is scanned, as the file's path, the start of its block
and a running number that grows with the rows of a block. It says which of two rows
came first whatever a later shuffle does. Files are in the order of their paths.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.session import scratch_path
from tabulon.sources.writers import write_layer


def place_in_files() -> Column:
    """Where a scanned row lies; to be selected from a scan itself, before anything moves or drops rows."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def is_scan(df: DataFrame) -> bool:
    """Whether rows still know the file they come from."""
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return False
    return True


def with_load_order(scan: DataFrame, name: str = "load_order") -> DataFrame:
    """Number the rows of a scan from 0 without gaps, in the order of files and of rows in a file.

    The rows are stored once with their places, so numbers stay the same for every reader. Running numbers are
    consecutive within a block, so a row's number is the rows in blocks before its own (a prefix sum over a row a
    block) plus its distance from the block's first row: no sort and no window over the rows themselves.
    """
    if not is_scan(scan):
        raise ValueError("Only rows of a file scan know the order they were delivered in")
    stored = write_layer(scan.select("*", place_in_files().alias("_place")), scratch_path(scan.sparkSession, "places"))
    blocks = stored.groupBy(F.col("_place.file").alias("_file"), F.col("_place.block").alias("_block")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place.line").alias("_first"))
    ahead = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)  # a row a block
    offsets = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)))
    same = (F.col("_place.file") == F.col("_file")) & (F.col("_place.block") == F.col("_block"))
    numbered = stored.join(offsets, same).withColumn(name, F.col("_before") + F.col("_place.line") - F.col("_first"))
    return numbered.select(*[F.col(f"`{c}`") for c in scan.columns if c != name], name)
