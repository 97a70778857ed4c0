"""Corrections as an append-only log that can be read as of any point.

Every append is a batch of its own with consecutive sequence numbers, and becomes
part of the log by one manifest entry. Nothing is ever rewritten, so a report made
last month can be made again from what was known then.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.operators.ordering import first_per_key, with_position
from tabulon.sources.versions import commit_folder, current_version, manifest, new_folder

SEQUENCE = "seq"


def append_corrections(new_rows: DataFrame, log: str, order: Sequence[str]) -> int:
    """Add corrections in the order of ``order``; returns the log's last sequence number.

    Rows equal in ``order`` come in any order, so it should tell apart corrections of one key. An append without
    rows leaves the log as it is.
    """
    spark = new_rows.sparkSession
    last = current_version(spark, log)
    base = int(last["note"]["last"]) if last else 0
    numbered = with_position(new_rows.drop(SEQUENCE), order).withColumn(SEQUENCE, (F.col("position") + 1 + base).cast("long"))
    folder = new_folder(log)
    numbered.drop("position", "series_rows").write.parquet(folder)
    rows = spark.read.parquet(folder).count()
    if rows:
        note = {"first": str(base + 1), "last": str(base + rows)}
        commit_folder(spark, log, folder, rows, note, expected=last["version"] if last else 0)
    return base + rows


def correction_log(
    spark: SparkSession, log: str, schema: T.StructType, as_of: int | None = None, at: datetime | None = None,
) -> DataFrame:
    """All corrections with their sequence numbers, up to number ``as_of`` or up to the appends of a moment.

    A log that does not exist yet has no rows. Appends after the point asked for are not read.
    """
    entries = manifest(spark, log)
    if at is not None:
        entries = entries.filter(F.col("committed_at") <= F.lit(at))
    if as_of is not None:
        entries = entries.filter(F.col("note")["first"].cast("long") <= as_of)
    # One folder an append.
    folders = [f"{log}/{r['folder']}" for r in entries.select("folder").collect()]
    whole = T.StructType([*[f for f in schema.fields if f.name != SEQUENCE], T.StructField(SEQUENCE, T.LongType())])
    rows = spark.read.schema(whole).parquet(*folders) if folders else spark.createDataFrame([], whole)
    return rows if as_of is None else rows.filter(F.col(SEQUENCE) <= as_of)


def corrections_as_of(
    spark: SparkSession, log: str, schema: T.StructType, key: str, as_of: int | None = None, at: datetime | None = None,
) -> DataFrame:
    """The last correction of each key, as of a sequence number or a moment."""
    return first_per_key(correction_log(spark, log, schema, as_of, at), [key], [F.col(SEQUENCE).desc()]).drop(SEQUENCE)
