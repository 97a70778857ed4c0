"""Sinks. Parquet is the working format; CSV and JSON Lines are exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header, no index, inner quotes doubled; arrays and maps are written as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = df.withColumns(
        {f.name: F.to_json(F.col(f.name)) for f in df.schema if isinstance(f.dataType, nested)}
    )
    flat.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One JSON record per line; null fields are kept, as a records export has them."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write one layer as Parquet and hand back a read of it.

    Reading it back ends the lineage: later steps restart from the stored table.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> str:
    """The one-row metrics table as JSON."""
    return write_json(metrics.coalesce(1), path)


def append_overrides(new_rows: DataFrame, path: str) -> DataFrame:
    """Add corrections to an append-only log, stamped with the time of writing.

    Readers keep the latest row per key, so nothing is rewritten in place.
    """
    new_rows.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)
    return new_rows.sparkSession.read.parquet(path)
