"""Rows that must not get lost, multiplied or reordered."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon import jobs
from tabulon.functions import date_rejects, to_date_any
from tabulon.operators.split import stratified_folds, stratified_split
from tabulon.plans.reading_log import _last_per_key, log_rows
from tabulon.schemas import BOARD_OVERRIDES, GEO_FIELDS, OFFICIAL, READING_OVERRIDES
from tabulon.sources import read_csv, read_or_empty, read_published_sheet
from tabulon.sources.writers import write_csv


def test_dates_of_mixed_shapes(spark):
    same = ["2021-01-05", "1/5/2021", "2021-1-5", "2021-01-05T00:00:00", "05-Jan-2021", "January 5, 2021", "Jan 5, 2021",
            " 2021/01/05 ", "2021-01-05 10:00:00", "5 Jan 2021"]
    rows = spark.createDataFrame([(t,) for t in [*same, "13/01/2021", "pending", None, "2021-02-30"]], "t string")
    got = [r[0] for r in rows.select(to_date_any(F.col("t"))).collect()]
    assert got == [datetime.date(2021, 1, 5)] * len(same) + [datetime.date(2021, 1, 13), None, None, None]


def test_dates_by_the_kinds_of_their_parts(spark):
    fifth = ["2021-01-05 00:00", "2021-01-05 00:00:00.000", "2021-01-05T00:00:00Z", "5 January 2021", "Jan 5 2021", "20210105", "01.05.2021",
             "1/5/21", "Tuesday, January 5th, 2021", "5-jan-21", "2021 Jan 5", "5 Jan 2021 10:30 PM", "2021/1/5 23:59:59,5+0100", "JAN. 5, 2021",
             "2021-01-05t07:00-06:00", "1-5-2021 7:05 a.m.", "20210105 10:11:12", "2021 5 Jan"]
    other = {"13.01.2021": (13, 1), "25/12/99": None, "Sept 2021": None, "2021-02": None, "3rd of March, 2021": None}
    rows = spark.createDataFrame([(t,) for t in [*fifth, *other]], "t string")
    got = {r[0]: r[1] for r in rows.select("t", to_date_any(F.col("t"))).collect()}
    assert [got[t] for t in fifth] == [datetime.date(2021, 1, 5)] * len(fifth)
    assert [got[t] for t in other] == [datetime.date(2021, 1, 13), datetime.date(1999, 12, 25), datetime.date(2021, 9, 1),
                                       datetime.date(2021, 2, 1), datetime.date(2021, 3, 3)]
    swapped = spark.createDataFrame([("05.01.2021",), ("5/1/21",), ("1/13/2021",)], "t string").select(to_date_any(F.col("t"), day_first=True))
    assert [r[0] for r in swapped.collect()] == [datetime.date(2021, 1, 5)] * 2 + [datetime.date(2021, 1, 13)]


def test_rejected_dates_are_counted_with_their_reason(spark):
    texts = [None, None, " ", "Unidades:", "Fuente: sheet 7", "2021-02-30", "2021-02-30", "31/31/2021", "12", "2021", "2021-01-05 25:00",
             "20211301", "1.2.3.4", "Mayo 5 2021", "2021-01-05"]
    got = {(r["text"], r["reason"]): r["rows"] for r in date_rejects(spark.createDataFrame([(t,) for t in texts], "d string"), "d").collect()}
    assert got == {
        (None, "missing"): 2, (" ", "missing"): 1, ("Unidades:", "no date"): 1, ("Fuente: sheet 7", "unknown form"): 1,
        ("2021-02-30", "no such day"): 2, ("31/31/2021", "no such day"): 1, ("12", "unknown form"): 1, ("2021", "unknown form"): 1,
        ("2021-01-05 25:00", "unknown form"): 1, ("20211301", "no such day"): 1, ("1.2.3.4", "unknown form"): 1, ("Mayo 5 2021", "unknown form"): 1}


def test_unlabelled_rows_stay_apart(spark):
    df = spark.range(100).withColumn("label", F.when(F.col("id") % 10 != 0, F.col("id") % 2))
    split = stratified_split(df, "label", ["id"])
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"test": 18, "train": 72, None: 10}
    folds = stratified_folds(df, "label", ["id"])
    assert folds.count() == 100 and folds.filter("fold is null").count() == 10


def test_corrections_keep_line_breaks_and_the_last_wins(spark, tmp_path):
    names = READING_OVERRIDES.names
    values = [{**dict.fromkeys(names), "filename": "a.jpg", "override_note": note} for note in ("first", "line one\nline two, with comma")]
    rows = spark.createDataFrame([tuple(v[n] for n in names) for v in values], READING_OVERRIDES).coalesce(1)
    write_csv(rows, str(tmp_path / "o"))
    back = read_or_empty(spark, str(tmp_path / "o"), READING_OVERRIDES, multi_line=True)
    assert [r["override_note"] for r in back.collect()] == [v["override_note"] for v in values]
    assert [r["override_note"] for r in _last_per_key(back, "filename").collect()] == [values[1]["override_note"]]


def test_other_column_order_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema).collect()


def test_wide_sheets_are_read_whole(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("title\n" + ",".join([*(f"c{i}" for i in range(90)), "DATE"]) + "\n" + ",".join([*"0" * 90, "2024-01-01"]) + "\n")
    assert "2024-01-01" in [r["day"] for r in read_published_sheet(spark, str(path), {"DATE": "day"}).collect()]


@pytest.fixture
def photos(spark):
    board = "struct<prices_raw: map<string,string>, crop_paths: map<string,string>, notes: array<string>>"
    dumps = spark.createDataFrame([("a", '{"Model": "new", "GPSLatitude": 1.0, "GPSLongitude": 2.0}'), ("b", "{}"), ("c", None)],
                                  "filename string, metadata string")
    recognised = spark.createDataFrame(
        [("a", ("15000", "5000", ["lcd_found"]), ({"v-power": "3100"}, {"diesel": "crop"}, ["x", "y"]))],
        f"filename string, pump struct<total_raw: string, gallons_raw: string, notes: array<string>>, board {board}")
    places = spark.createDataFrame([(1.0, 2.0, "Town")], "lat4 double, lon4 double, city string")
    return dumps, recognised, places


def test_log_takes_over_built_rows_unless_forced(spark, photos):
    previous = spark.createDataFrame([("a", "old"), ("gone", "old")], "filename string, camera_model string")

    def models(*args, **more):
        rows = log_rows(*photos, *args, place_fields=["city"], **more).collect()
        return sorted((r["filename"], r["camera_model"], r["geo_city"]) for r in rows)

    built = [("a", "new", "Town"), ("b", None, None), ("c", None, None)]
    assert models() == models(previous, force=True) == built
    assert models(previous) == [("a", "old", None), *built[1:]]


def test_log_jobs_feed_each_other(spark, photos, tmp_path):
    """Build, correct and refresh from the stored dataset."""
    at = lambda name: str(tmp_path / name)
    names = ["dumps", "recognised", "places"]
    full = photos[2].select("lat4", "lon4", *[(F.col("city") if f == "city" else F.lit(None).cast("string")).alias(f) for f in GEO_FIELDS])
    for name, table in zip(names, [*photos[:2], full]):
        table.write.parquet(at(name))
    official = spark.createDataFrame([], OFFICIAL)
    write_csv(official, at("official"))
    outputs = ["official", "d1", "j1", "p1"]
    jobs.main(["build", *map(at, [*names, "none", "board0", *outputs])])
    first = {r["filename"]: r for r in spark.read.parquet(at("d1")).collect()}
    assert first["a"]["total_gtq"] == 150.0 and first["a"]["geo_city"] == "Town" and first["a"]["board_notes"] == "x;y"
    values = {**dict.fromkeys(BOARD_OVERRIDES.names), "filename": "b", "price_diesel_gtq": 25.5, "note": "two\nlines"}
    write_csv(spark.createDataFrame([tuple(values[n] for n in BOARD_OVERRIDES.names)], BOARD_OVERRIDES), at("typed"))
    jobs.main(["correct", at("typed"), at("board0"), at("board1"), "--board"])
    jobs.main(["refresh", "--stored", *map(at, ["d1", "none", "board1", "official", "d2", "j2", "p2"])])
    second = {r["filename"]: r for r in spark.read.parquet(at("d2")).collect()}
    assert second.keys() == first.keys() and second["a"]["total_gtq"] == 150.0
    assert second["b"]["price_diesel_gtq"] == 25.5 and second["b"]["board_override_note"] == "two\nlines"
