"""Upsert by key as a log of batches, with snapshots that keep reads short.

Every micro-batch leaves the last row of each of its keys under the stream's own
identity and the batch's number. A snapshot holds the last row of every key up to
some batch of every stream; it is a whole version of a table, so the switch to a new
one is a single file. A read takes the current snapshot and the batches after it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabulon.operators.ordering import first_per_key
from tabulon.sources.versions import commit_version, current_version, read_version

RUN, BATCH = "run", "batch_id"
_QUERY_ID = "sql.streaming.queryId"


def merge_stream(
    stream: DataFrame, log: str, checkpoint: str, key: Sequence[str], order: Sequence[str],
    derive: Callable[[DataFrame], DataFrame] | None = None, compact_every: int | None = None,
) -> StreamingQuery:
    """Upsert by key, last write wins by ``order``.

    Every micro-batch is reduced to its last row per key, passed through ``derive`` and written under the stream's
    identity and its batch number. A batch that is run again overwrites its own folder only; a stream whose
    checkpoint was lost starts under a new identity, and the rows' own order settles what it repeats. The cost of a
    batch follows the batch, not the table. With ``compact_every``, a snapshot is taken after as many batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty(_QUERY_ID)
        last = first_per_key(batch, key, [F.col(c).desc() for c in order])
        rows = derive(last) if derive else last
        rows.write.mode("overwrite").parquet(f"{log}/batches/{RUN}={run}/{BATCH}={batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(spark, log, key, order)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _batches(spark: SparkSession, log: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{log}/batches")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _after(covered: dict[str, int]) -> Column:
    """Batches that a snapshot does not hold: a filter on folders, so older ones are not even listed for reading."""
    new = ~F.col(RUN).isin(*covered) if covered else F.lit(True)
    for run, batch in covered.items():
        new = new | ((F.col(RUN) == run) & (F.col(BATCH) > batch))
    return new


def _rows(spark: SparkSession, log: str, upto: dict[str, int] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Snapshot and the batches after it (up to ``upto``), and the batches that the snapshot covers."""
    entry = current_version(spark, f"{log}/snapshots")
    covered = {r: int(b) for r, b in (entry["note"] or {}).items()} if entry else {}
    parts = [read_version(spark, f"{log}/snapshots", entry["version"])] if entry else []
    batches = _batches(spark, log)
    if batches is not None:
        fresh = batches.filter(_after(covered))
        if upto is not None:
            fresh = fresh.filter(~_after(upto))
        parts.append(fresh.withColumns({RUN: F.col(RUN).cast("string"), BATCH: F.col(BATCH).cast("long")}))
    if not parts:
        raise LookupError(f"No batch has been merged into {log}")
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)), covered


def _last(key: Sequence[str], order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() for c in (*order, BATCH, RUN)]


def latest_versions(spark: SparkSession, log: str, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The current table behind a merge log: each key's last row, by ``order`` and then by batch.

    With ``order`` the row itself decides which is last, whatever order files arrived in. Costs the snapshot and
    the batches since.
    """
    return first_per_key(_rows(spark, log)[0], key, _last(key, order)).drop(RUN, BATCH)


def compact(spark: SparkSession, log: str, key: Sequence[str], order: Sequence[str]) -> int:
    """Take a snapshot of all batches so far and make it the current one; returns its version.

    ``order`` must say which row is last, as snapshots forget the others. Runs between batches or while the stream
    stands still. If it fails, reads go on from the snapshot before it. Batch folders stay; reads pass them by.
    """
    if not order:
        raise ValueError("A snapshot needs columns that say which row of a key is last")
    batches = _batches(spark, log)
    entry = current_version(spark, f"{log}/snapshots")
    # A row for every stream that ever wrote here, from folder names alone.
    ends = {} if batches is None else {
        r[RUN]: r["b"] for r in batches.groupBy(F.col(RUN).cast("string").alias(RUN)).agg(F.max(BATCH).alias("b")).collect()}
    rows, covered = _rows(spark, log, ends)
    if entry and all(covered.get(run, -1) >= b for run, b in ends.items()):
        return entry["version"]
    note = {run: str(max(b, covered.get(run, -1))) for run, b in {**covered, **ends}.items()}
    last = first_per_key(rows, key, _last(key, order))
    return commit_version(last, f"{log}/snapshots", note, expected=entry["version"] if entry else 0)
