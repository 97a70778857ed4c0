"""Order of delivery, and corrections as they were known at some point."""

import datetime

import pytest
from pyspark.sql import functions as F

from tabulon.operators.clean import clean_customers
from tabulon.schemas import CHURN, READING_OVERRIDES
from tabulon.sources import read_csv
from tabulon.sources.corrections import append_corrections, correction_log, corrections_as_of
from tabulon.sources.file_order import with_load_order
from tabulon.sources.versions import manifest


def customers(path, name, rows):
    line = {"gender": "F", "TotalCharges": "1"}
    lines = [",".join(CHURN.names)]
    lines += [",".join(str({**line, "customerID": k, "tenure": t}.get(c, "0")) for c in CHURN.names) for k, t in rows]
    (path / name).write_text("\n".join(lines) + "\n")


def test_a_small_first_file_beats_a_larger_later_one(spark, tmp_path):
    customers(tmp_path, "a.csv", [("K", 1)])
    customers(tmp_path, "b.csv", [(f"other {i}", 50) for i in range(3000)] + [("K", 2), ("L", 3), ("L", 4)])
    raw = read_csv(spark, [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")], CHURN)
    kept = clean_customers(raw)
    assert sorted(r["tenure"] for r in kept.filter("tenure < 50").collect()) == [1, 3]
    with pytest.raises(ValueError, match="which duplicate comes first"):
        clean_customers(raw.groupBy(*raw.columns).count().drop("count"))
    ordered = clean_customers(raw.repartition(7), [F.col("tenure").cast("int")])
    assert sorted(r["tenure"] for r in ordered.filter("tenure < 50").collect()) == [1, 3]


def test_load_order_is_dense_over_files_and_blocks(spark, tmp_path):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")  # several blocks a file
    try:
        for name, rows in (("a", range(3)), ("b", range(3, 900)), ("c", []), ("d", range(900, 950))):
            (tmp_path / f"{name}.txt").write_text("".join(f"row {i}\n" for i in rows))
        got = with_load_order(spark.read.text([str(tmp_path / f"{n}.txt") for n in "dbca"])).repartition(5).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r["value"]: r["load_order"] for r in got} == {f"row {i}": i for i in range(950)}
    with pytest.raises(ValueError):
        with_load_order(spark.range(3))


def rows(spark, *values):
    names = READING_OVERRIDES.names
    return spark.createDataFrame([tuple({**dict.fromkeys(names), "filename": f, "override_note": n}[c] for c in names) for f, n in values],
                                 READING_OVERRIDES)


def test_corrections_as_of_any_point(spark, tmp_path):
    log = str(tmp_path / "log")
    assert correction_log(spark, log, READING_OVERRIDES).count() == 0
    assert append_corrections(rows(spark, ("a", "1"), ("b", "2"), ("a", "3")), log, ["override_note"]) == 3
    moment = manifest(spark, log).first()["committed_at"]
    assert append_corrections(rows(spark), log, ["override_note"]) == 3
    assert append_corrections(rows(spark, ("b", "4"), ("c", "5")), log, ["override_note"]) == 5

    def known(**point):
        return {r["filename"]: r["override_note"] for r in corrections_as_of(spark, log, READING_OVERRIDES, "filename", **point).collect()}

    assert [known(as_of=n) for n in (0, 1, 3, 4)] == [{}, {"a": "1"}, {"a": "3", "b": "2"}, {"a": "3", "b": "4"}]
    assert known() == {"a": "3", "b": "4", "c": "5"} and known(at=moment) == {"a": "3", "b": "2"}
    assert known(at=moment - datetime.timedelta(seconds=60)) == {}
    # Only appends up to the point are read.
    assert len(corrections_as_of(spark, log, READING_OVERRIDES, "filename", as_of=2).inputFiles()) < len(
        correction_log(spark, log, READING_OVERRIDES).inputFiles())
