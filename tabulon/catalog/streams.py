"""Jobs that write: layers, refresh, and file streams. Everything goes to fresh scratch paths."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.catalog import standins as S
from tabulon.catalog.cleaning import CLEAN_SQL, cleaned_lines
from tabulon.catalog.learning import _CATEGORICAL, _NUMERIC, _SPLIT_SQL, graded_split
from tabulon.catalog.readings import EXPORT_SQL, rounded_export
from tabulon.catalog.registry import query, table
from tabulon.ml import InverseStrengthLogisticRegression, build_model, score
from tabulon.operators.features import public_export
from tabulon.operators.split import stratified_split
from tabulon.plans.reading_log import ReadingLogPaths, refresh
from tabulon.session import scratch_path
from tabulon.sources.versions import commit_version, read_version
from tabulon.sources.writers import write_csv, write_layer
from tabulon.streaming import (
    compact, file_stream, ingest_new_files, latest_versions, merge_stream, score_stream, upsert_stream, upserted,
)


@query(EXPORT_SQL)
def refresh_job(spark, folder):
    """Write corrections and references, run the refresh, export from the stored dataset."""
    out = scratch_path(spark, "log")
    paths = ReadingLogPaths(*[f"{out}/{p}" for p in
                              ("overrides", "board_overrides", "official", "dataset", "json", "public")])
    write_csv(S.overrides(spark, folder), paths.reading_overrides)
    write_csv(S.board_overrides(spark, folder), paths.board_overrides)
    write_csv(S.official(spark, folder), paths.official)
    stored = refresh(spark, S.readings(spark, folder), paths)
    return rounded_export(public_export(stored, S.official(spark, folder)))


@query(CLEAN_SQL)
def medallion(spark, folder):
    """Raw copy, then cleaned rows; each layer is committed as a whole and reads only the one before it."""
    out = scratch_path(spark, "layers")
    commit_version(table(spark, folder, "lineitem"), f"{out}/bronze")
    commit_version(cleaned_lines(read_version(spark, f"{out}/bronze")), f"{out}/silver")
    return read_version(spark, f"{out}/silver")


@query(_SPLIT_SQL + """
SELECT split, quality, count(*) AS n, round(avg(n_chars), 4) AS mean_chars, count(DISTINCT lang) AS languages
FROM parts JOIN documents USING (doc_id) GROUP BY split, quality""")
def gold_table(spark, folder):
    """Bronze copies, labelled rows as silver, and the profile of their split as gold; each layer reads one whole version."""
    out = scratch_path(spark, "gold")
    for name in ("documents", "labels"):
        commit_version(table(spark, folder, name), f"{out}/bronze/{name}")
    documents, labels = (read_version(spark, f"{out}/bronze/{n}") for n in ("documents", "labels"))
    silver = documents.select("doc_id", "lang", "n_chars").join(labels.select("doc_id", "quality"), "doc_id")
    commit_version(silver, f"{out}/silver")
    parts = stratified_split(read_version(spark, f"{out}/silver"), "quality", ["doc_id"])
    profile = parts.groupBy("split", "quality").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars"), F.count_distinct("lang").alias("languages"))
    commit_version(profile, f"{out}/gold")
    return read_version(spark, f"{out}/gold")


def table_stream(spark, folder: str, name: str) -> DataFrame:
    """A stream of the table's files, be the table one file or a folder of part files.

    The braces make the path a pattern: of one that is none Spark asks that it be a folder.
    """
    return file_stream(spark, f"{folder}/{{{name}.parquet}}", table(spark, folder, name).schema)


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_ingest(spark, folder):
    out = scratch_path(spark, "ingest")
    stream = table_stream(spark, folder, "events")
    ingest_new_files(
        stream.select("event_id", "user_id", "event_type", "value"), f"{out}/table", f"{out}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{out}/table")


def land_by_week(events: DataFrame, path: str, rows_per_file: int = 1_000_000) -> DataFrame:
    """Write events under their week, cut by range so that tasks and files hold about ``rows_per_file`` rows at most.

    The number of ranges grows with the rows, and the cut points are Spark's own sample of (week, ts, event_id), so a
    week with a burst goes to as many tasks and files as its rows ask for.
    """
    weekly = events.withColumn("week", F.weekofyear("ts"))
    order, ranges = ["week", "ts", "event_id"], max(1, math.ceil(events.count() / rows_per_file))
    return write_layer(weekly.repartitionByRange(ranges, *order).sortWithinPartitions(*order), path, partition_by=["week"])


_MERGED_SQL = """
SELECT user_id, event_id, event_type, round(value * 2, 4) AS doubled FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
_MERGED = ["user_id", "event_id", "event_type", "doubled"]
_KEY, _ORDER = ["user_id"], ["ts", "event_id"]
_BATCH_BYTES = 1 << 30


def _doubled(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doubled", F.round(F.col("value") * 2, 4))


@query(_MERGED_SQL)
def stream_merge(spark, folder):
    """Events land as files by week; micro-batches of bounded bytes are upserted by user."""
    out = scratch_path(spark, "merge")
    events = table(spark, folder, "events")
    land_by_week(events, f"{out}/landing")
    stream = file_stream(spark, f"{out}/landing/*", events.schema, bytes_per_batch=_BATCH_BYTES)
    merge_stream(stream, f"{out}/log", f"{out}/checkpoint", _KEY, _ORDER, _doubled).awaitTermination()
    return latest_versions(spark, f"{out}/log", _KEY, _ORDER).select(*_MERGED)


@query(_MERGED_SQL)
def stream_compact(spark, folder):
    """Even weeks are merged and compacted; odd weeks, most of them late, are merged on top; the read takes snapshot and log.

    The odd weeks come from a stream that lost its checkpoint and so repeats the even ones.
    """
    out = scratch_path(spark, "compact")
    events = table(spark, folder, "events")
    land_by_week(events.filter(F.weekofyear("ts") % 2 == 0), f"{out}/landing")

    def merge(checkpoint: str) -> None:
        stream = file_stream(spark, f"{out}/landing/*", events.schema, bytes_per_batch=_BATCH_BYTES)
        merge_stream(stream, f"{out}/log", f"{out}/{checkpoint}", _KEY, _ORDER, _doubled).awaitTermination()

    merge("checkpoint")
    compact(spark, f"{out}/log", _KEY, _ORDER)
    late = events.filter(F.weekofyear("ts") % 2 == 1).withColumn("week", F.weekofyear("ts"))
    write_layer(late, f"{out}/landing", mode="append", partition_by=["week"])
    merge("checkpoint-after-loss")
    return latest_versions(spark, f"{out}/log", _KEY, _ORDER).select(*_MERGED)


@query(_MERGED_SQL)
def stream_state(spark, folder):
    """The same upsert with each user's last event as state in RocksDB."""
    out = scratch_path(spark, "state")
    events = table(spark, folder, "events")
    land_by_week(events, f"{out}/landing")
    stream = file_stream(spark, f"{out}/landing/*", events.schema, bytes_per_batch=_BATCH_BYTES)
    upsert_stream(stream, f"{out}/changes", f"{out}/checkpoint", _KEY, _ORDER, _doubled).awaitTermination()
    return upserted(spark, f"{out}/changes", _KEY).select(*_MERGED)


@query("SELECT doc_id, TRUE AS same_as_batch FROM documents")
def stream_score(spark, folder):
    """Documents arrive as files, meet their labels and are scored; each score is held against the batch one."""
    out = scratch_path(spark, "score")
    train, _ = graded_split(spark, folder)
    model = build_model(InverseStrengthLogisticRegression(), _NUMERIC, _CATEGORICAL).fit(train)
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")

    def features(rows):
        return rows.join(labels, "doc_id", "left").select("doc_id", *_NUMERIC, *_CATEGORICAL)

    stream = table_stream(spark, folder, "documents")
    score_stream(features(stream), model, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    batch = score(model, features(documents)).select(
        "doc_id", F.col("score_probability").alias("_p"), F.col("score_predicted").alias("_c"))
    same = (F.abs(F.col("score_probability") - F.col("_p")) < 1e-12) & (F.col("score_predicted") == F.col("_c"))
    return spark.read.parquet(f"{out}/table").join(batch, "doc_id", "left").select(
        "doc_id", F.coalesce(same, F.lit(False)).alias("same_as_batch"))
