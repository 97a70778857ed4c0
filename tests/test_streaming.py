from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabulon.catalog.streams import land_by_week, stream_ingest, stream_score
from tabulon.session import scratch_path, shared_folder
from tabulon.sources.versions import commit_version, current_version, manifest, read_version
from tabulon.streaming import (
    compact, file_stream, ingest_new_files, latest_versions, merge_log, merge_stream, upsert_stream, upserted,
)

SCHEMA = "k string, v int, at int"


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


@pytest.fixture()
def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_each_file_once(spark, schema, tmp_path):
    root = str(tmp_path)

    def run():
        ingest_new_files(file_stream(spark, f"{root}/in/*", schema), f"{root}/out", f"{root}/cp").awaitTermination()
        return sorted(r["v"] for r in spark.read.parquet(f"{root}/out").collect())

    land(spark, f"{root}/in", "one", [("a", 1, 1)])
    assert run() == [1]
    land(spark, f"{root}/in", "two", [("b", 2, 2)])
    assert run() == [1, 2]
    assert run() == [1, 2]


def test_merge_keeps_last_write_and_replays_safely(spark, schema, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/in", "one", [("a", 1, 1), ("a", 2, 2), ("b", 3, 1)])

    def run(checkpoint):
        merge_stream(
            file_stream(spark, f"{root}/in/*", schema), f"{root}/log", checkpoint, ["k"], ["at"],
            lambda d: d.withColumn("double", F.col("v") * 2),
        ).awaitTermination()
        return {r["k"]: (r["v"], r["double"]) for r in latest_versions(spark, f"{root}/log", ["k"]).collect()}

    assert run(f"{root}/cp") == {"a": (2, 4), "b": (3, 6)}
    land(spark, f"{root}/in", "two", [("a", 9, 5)])
    assert run(f"{root}/cp") == {"a": (9, 18), "b": (3, 6)}
    assert run(f"{root}/cp") == {"a": (9, 18), "b": (3, 6)}
    # A lost checkpoint replays everything under a new identity; the row order still decides.
    run(f"{root}/cp2")
    again = {r["k"]: r["v"] for r in latest_versions(spark, f"{root}/log", ["k"], ["at"]).collect()}
    assert again == {"a": 9, "b": 3}


def folders(log):
    return sorted(f"{run.name}/{batch.name}" for run in (log / "batches").glob("run=*") for batch in run.glob("batch_id=*"))


def test_reads_cost_a_snapshot_and_the_batches_after_it(spark, schema, tmp_path):
    log, inbox = tmp_path / "log", f"{tmp_path}/in"

    def merge(checkpoint="cp", **options):
        merge_stream(file_stream(spark, f"{inbox}/*", schema, files_per_batch=1), str(log), f"{tmp_path}/{checkpoint}", ["k"], ["at"],
                     **options).awaitTermination()

    def table():
        return {r["k"]: (r["v"], r["at"]) for r in latest_versions(spark, str(log), ["k"], ["at"]).collect()}

    def batches_read():
        files = merge_log._rows(spark, str(log))[0].select(F.input_file_name()).distinct().collect()
        return {r[0].split("batch_id=")[1].split("/")[0] for r in files if "/batches/" in r[0]}

    with pytest.raises(LookupError):
        latest_versions(spark, str(log), ["k"], ["at"])
    land(spark, inbox, "one", [("a", 1, 1), ("b", 2, 5), (None, 3, 1)])
    land(spark, inbox, "two", [("a", 4, 4), ("b", 5, 2), ("c", 6, 1)])
    merge()
    want = {"a": (4, 4), "b": (2, 5), "c": (6, 1), None: (3, 1)}
    assert table() == want
    assert compact(spark, str(log), ["k"], ["at"]) == 1 and compact(spark, str(log), ["k"], ["at"]) == 1  # nothing new: no new version
    assert not batches_read() and table() == want
    land(spark, inbox, "three", [("a", 7, 3), ("c", 8, 9), ("d", 9, 1)])  # the row of a comes late
    merge()
    want |= {"c": (8, 9), "d": (9, 1)}
    assert batches_read() == {"2"} and table() == want
    # The checkpoint is lost: the new stream repeats all batches from number 0, and brings a new one.
    land(spark, inbox, "four", [("b", 10, 6), ("a", 11, 2)])
    merge("cp-new")
    want |= {"b": (10, 6)}
    assert len(folders(log)) == 7 and table() == want
    assert compact(spark, str(log), ["k"], ["at"]) == 2 and table() == want
    merge(), merge("cp-new")
    assert table() == want
    with pytest.raises(ValueError):
        compact(spark, str(log), ["k"], [])


def test_a_batch_that_runs_again_overwrites_its_own_folder(spark, schema, tmp_path):
    land(spark, f"{tmp_path}/in", "one", [("a", 1, 1)])
    land(spark, f"{tmp_path}/in", "two", [("a", 2, 2)])
    log, failed = tmp_path / "log", []

    def once(rows):
        if rows.filter("v = 2").count() and not failed:
            failed.append(1)
            raise RuntimeError("lost")
        return rows

    def merge():
        merge_stream(file_stream(spark, f"{tmp_path}/in/*", schema, files_per_batch=1), str(log), f"{tmp_path}/cp", ["k"], ["at"], once,
                     compact_every=2).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        merge()
    merge()
    assert len(folders(log)) == 2 and len({f.split("/")[0] for f in folders(log)}) == 1
    assert current_version(spark, f"{log}/snapshots")["version"] == 1
    assert [(r["k"], r["v"]) for r in latest_versions(spark, str(log), ["k"], ["at"]).collect()] == [("a", 2)]


def test_a_failed_write_stays_invisible(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(LookupError):
        read_version(spark, path)
    assert commit_version(spark.range(3), path, {"why": "first"}, expected=0) == 1
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        commit_version(bad.repartition(3), path)
    spark.range(9).write.parquet(f"{path}/data/whole-but-never-committed")
    assert read_version(spark, path).count() == 3 and current_version(spark, path)["note"] == {"why": "first"}
    assert commit_version(read_version(spark, path).unionByName(spark.range(10, 12)), path, expected=1) == 2
    with pytest.raises(RuntimeError):
        commit_version(spark.range(1), path, expected=1)
    assert (read_version(spark, path).count(), read_version(spark, path, 1).count(), manifest(spark, path).count()) == (5, 3, 2)
    with pytest.raises(LookupError):
        read_version(spark, path, 7)


def test_state_keeps_the_last_row_whatever_the_order_of_arrival(spark, schema, tmp_path):
    inbox = f"{tmp_path}/in"

    def run(checkpoint="cp"):
        stream = file_stream(spark, f"{inbox}/*", schema, files_per_batch=1)
        upsert_stream(stream, f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", ["k"], ["at", "v"], lambda d: d.withColumn("twice", F.col("v") * 2)).awaitTermination()
        return {r["k"]: (r["v"], r["at"], r["twice"]) for r in upserted(spark, f"{tmp_path}/out", ["k"]).collect()}

    def written():
        changes = spark.read.parquet(f"{tmp_path}/out")
        return Counter(r["change_id"] for r in changes.select("change_id").collect())

    land(spark, inbox, "a", [("a", 1, 5), ("a", 2, 3), ("b", 3, None), (None, 4, 1)])
    assert run() == {"a": (1, 5, 2), "b": (3, None, 6), None: (4, 1, 8)} and written() == {0: 3}
    # Late, equal and repeated rows change nothing; a null order comes before all others.
    land(spark, inbox, "b", [("a", 9, 4), ("a", 1, 5), ("b", 2, None), (None, 4, 1)])
    assert run()["a"] == (1, 5, 2) and written() == {0: 3}
    land(spark, inbox, "c", [("a", 0, 6), ("b", 7, 0), ("c", 8, 8)])
    want = {"a": (0, 6, 0), "b": (7, 0, 14), "c": (8, 8, 16), None: (4, 1, 8)}
    assert run() == want and written() == {0: 3, 2: 3}
    log = f"{tmp_path}/log"
    merge_stream(file_stream(spark, f"{inbox}/*", schema), log, f"{tmp_path}/cp2", ["k"], ["at", "v"]).awaitTermination()
    assert {r["k"]: (r["v"], r["at"], r["v"] * 2) for r in latest_versions(spark, log, ["k"], ["at", "v"]).collect()} == want


def test_scratch_paths_are_fresh_and_shared(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert spark.sparkContext.getCheckpointDir() is not None
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")


def test_a_burst_week_lands_in_several_files(spark, tmp_path):
    events = spark.range(1100).select(
        F.col("id").alias("event_id"), F.when(F.col("id") >= 1090, None).when(F.col("id") < 1000, F.timestamp_seconds(F.col("id") % 7 + 1_600_000_000))
        .otherwise(F.timestamp_seconds(1_600_000_000 + 604_800 * (F.col("id") % 5 + 1))).alias("ts"))
    landed = land_by_week(events, str(tmp_path / "landing"), rows_per_file=100)
    assert sorted(map(str, landed.select("event_id", "ts").collect())) == sorted(map(str, events.collect()))
    burst = landed.filter("event_id < 1000").select("week", F.input_file_name().alias("file")).collect()
    files = Counter(r["file"] for r in burst)
    assert len({r["week"] for r in burst}) == 1 and len(files) >= 8 and max(files.values()) <= 250


def graded_documents(spark, folder, files):
    """Documents and labels, the documents as a folder of so many files."""
    rows = [(i, "abc"[i % 3], "xy"[i % 2] if i % 5 else None, 10 * i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long")
    docs.repartition(files).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, int(i % 4 < 2), int(i % 7 == 0)) for i in range(50)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")


def test_stream_of_a_table_that_is_a_folder(spark, tmp_path):
    root = str(tmp_path)
    graded_documents(spark, root, 3)
    found = stream_score(spark, root).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(60)) and all(r["same_as_batch"] for r in found)
    rows = spark.range(40).selectExpr("id AS event_id", "id % 3 AS user_id", "'click' AS event_type", "id / 2 AS value")
    rows.repartition(4).write.parquet(f"{root}/events.parquet")
    assert sorted(r["event_id"] for r in stream_ingest(spark, root).collect()) == list(range(40))
