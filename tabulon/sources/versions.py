"""Tables in whole versions: data goes to a folder of its own, then one small file makes it the current one.

A reader follows the newest entry of the manifest, so it sees all of a version or
nothing of it: a write that fails on the way leaves data that no entry names. An
entry is one file that one task commits, which stores do as a whole. One writer at a
time; readers may come at any time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, folder string, rows long, note map<string,string>, committed_at timestamp"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A line for every committed version; none if there is no such table yet."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def current_version(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    """The newest entry (or that of one version); None if there is none."""
    entries = manifest(spark, path)
    if version is not None:
        entries = entries.filter(F.col("version") == version)
    return entries.orderBy(F.col("version").desc(), F.col("committed_at").desc(), "folder").first()


def new_folder(path: str) -> str:
    """A folder of its own for the parts of a version that isn't committed yet."""
    return f"{path}/data/{uuid.uuid4().hex}"


def commit_folder(
    spark: SparkSession, path: str, folder: str, rows: int, note: Mapping[str, str] | None = None, expected: int | None = None,
) -> int:
    """Make a finished folder of :func:`new_folder` the current version; its number is returned.

    ``note`` goes into the entry. With ``expected``, the current version must still be that one (0: none yet), or
    nothing is committed.
    """
    last = current_version(spark, path)
    number = last["version"] if last else 0
    if expected is not None and number != expected:
        raise RuntimeError(f"Version {number} was committed meanwhile, {expected} was expected")
    entry = spark.range(1).select(
        F.lit(number + 1).cast("long").alias("version"), F.lit(folder.removeprefix(f"{path}/")).alias("folder"),
        F.lit(rows).cast("long").alias("rows"), F.lit(None).cast("map<string,string>").alias("note") if not note else
        F.create_map(*[F.lit(x) for pair in note.items() for x in pair]).alias("note"), F.current_timestamp().alias("committed_at"))
    entry.coalesce(1).write.mode("append").json(f"{path}/manifest")
    return number + 1


def commit_version(
    df: DataFrame, path: str, note: Mapping[str, str] | None = None, partition_by: Sequence[str] = (), expected: int | None = None,
) -> int:
    """Write a new version of the whole table and make it the current one; ``df`` may read the version before it."""
    spark, folder = df.sparkSession, new_folder(path)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return commit_folder(spark, path, folder, spark.read.schema(df.schema).parquet(folder).count(), note, expected)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current version of a table, or an earlier one."""
    entry = current_version(spark, path, version)
    if entry is None:
        raise LookupError(f"{path} has no version" + ("" if version is None else f" {version}"))
    return spark.read.parquet(f"{path}/{entry['folder']}")
