"""Deciding what still has to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def unprocessed(source: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Source rows whose key the target does not hold yet; all of them under ``force``."""
    if force:
        return source
    return source.join(done.select(key), key, "left_anti")


def reuse_and_new(done: DataFrame, new: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Finished rows still present in the source, plus the newly processed ones."""
    kept = done.join(source.select(key), key, "left_semi")
    return kept.unionByName(new, allowMissingColumns=True)


def stale_only(
    source: DataFrame, manifest: DataFrame, key: str, changed: str, finished: str
) -> DataFrame:
    """Source rows never finished, or changed after they were finished."""
    done = manifest.groupBy(key).agg(F.max(finished).alias("_finished"))
    joined = source.join(done, key, "left")
    return joined.filter(F.col("_finished").isNull() | (F.col("_finished") < F.col(changed))).drop("_finished")


def file_manifest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path, name, size and change time of each file; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("changed_at"),
    )
