"""Where queries and their SQL twins are declared."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Runner
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a function under its own name; ``sql`` is omitted where SQL has no equivalent."""

    def register(run: Runner) -> Runner:
        CATALOG[run.__name__] = Entry(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
