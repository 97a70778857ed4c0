"""The last row of every key as streaming state, kept in RocksDB and changed only by later rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on local disks with a change log in the checkpoint, not in the executors' heap."""
    spark.conf.set(_PROVIDER, _ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class LastRow(StatefulProcessor):
    """One row a key: that with the greatest ``order``, nulls being least. Equal or earlier rows change nothing.

    Rows of a key stream past; only the row kept is in memory, however many a batch brings. A key gives a row
    whenever a batch moved it on.
    """

    def __init__(self, schema: T.StructType, order: Sequence[str]):
        self.schema = schema
        self.at = [schema.names.index(c) for c in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last", self.schema)

    def _rank(self, row: tuple) -> tuple:
        return tuple((row[i] is not None, row[i]) if row[i] is not None else (False,) for i in self.at)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        best = tuple(self.state.get()) if self.state.exists() else None
        rank = None if best is None else self._rank(best)
        moved = False
        for row in rows:
            values = tuple(row)
            mine = self._rank(values)
            if rank is None or mine > rank:
                best, rank, moved = values, mine, True
        if moved:
            self.state.update(best)
            yield Row(**dict(zip(self.schema.names, best)))

    def close(self) -> None:
        pass


def last_rows(stream: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each key's last row whenever it changes: a stream in update mode.

    Late rows and rows that come again are settled by ``order``, which should tell all rows of a key apart; of rows
    equal in it the first to come stays. ``key`` columns with nulls are keys like others. State has one row a key.
    """
    use_rocksdb(stream.sparkSession)
    return stream.groupBy(*key).transformWithState(LastRow(stream.schema, order), stream.schema, "Update", "None")


def upsert_stream(
    stream: DataFrame, target: str, checkpoint: str, key: Sequence[str], order: Sequence[str],
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write the changes of every batch as ``change_id=N``; :func:`upserted` reads them as a table.

    Only keys that moved on are written, at most one row a key and batch. A batch that is run again starts from
    the state before it and overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = derive(batch) if derive else batch
        rows.write.mode("overwrite").parquet(f"{target}/change_id={batch_id}")

    return (
        last_rows(stream, key, order).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upserted(spark: SparkSession, target: str, key: Sequence[str]) -> DataFrame:
    """The table behind :func:`upsert_stream`: the change of the highest number of each key, one partial maximum a task."""
    changes = spark.read.parquet(target)
    columns = [c for c in changes.columns if c != "change_id"]
    last = F.max_by(F.struct(*columns), F.col("change_id")).alias("_last")
    return changes.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(last).select("_last.*")
