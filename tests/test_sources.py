from __future__ import annotations

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.operators.clean import clean_official
from tabulon.schemas import BOARD_READING, OFFICIAL_PRICES, PUMP_READING, READING_OVERRIDES
from tabulon.sources import (
    append_overrides, file_manifest, flatten_reading, metadata_fields, read_csv, read_or_empty,
    read_published_sheet, reuse_and_new, stale_only, unprocessed, write_csv, write_json,
)

PERSON = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("code", T.StringType()),
    T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("ok", T.BooleanType()),
])


def test_csv_by_name_with_quotes_zeros_and_missing(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('x,Unnamed: 0,ok,name,code,n\n1.5,0,True,"say ""hi"", ok",0938,7\nNaN,1,False,NA,,bad\n')
    rows = read_csv(spark, str(path), PERSON).collect()
    assert rows[0] == Row(name='say "hi", ok', code="0938", n=7, x=1.5, ok=True)
    assert rows[1] == Row(name=None, code=None, n=None, x=None, ok=False)
    with pytest.raises(KeyError, match="gone"):
        read_csv(spark, str(path), T.StructType([T.StructField("gone", T.StringType())]))


def test_optional_table(spark, tmp_path):
    empty = read_or_empty(spark, str(tmp_path / "none.csv"), READING_OVERRIDES)
    assert empty.count() == 0 and empty.columns == READING_OVERRIDES.names


def test_published_sheet(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(
        "Title,,\n,,\nFECHA , Tipo de Cambio,Extra,Sup,Reg,Die\nUnidades:,GTQ/USD,,GTQ,GTQ,GTQ\n"
        "2024-01-05,7.1,x,30,29,28\n2020-12-31,7,x,1,1,1\n01/05/2024,7.2,x,31,n/d,28.5\nFuente: x,,,,,\n"
    )
    names = dict(zip(["FECHA", "Tipo de Cambio", "Sup", "Reg", "Die"], ["date", *OFFICIAL_PRICES]))
    sheet = read_published_sheet(spark, str(path), names)
    rows = clean_official(sheet, F.monotonically_increasing_id()).collect()
    assert [(str(r["date"]), r["exchange_rate_usd_gtq"], r["official_super_gtq"], r["official_regular_gtq"]) for r in rows] == [
        ("2024-01-05", 7.2, 31.0, None)
    ]


def test_metadata_and_flattening(spark):
    dumps = [
        json.dumps({"DateTimeOriginal": "2026:07:09 19:42:19", "ExifImageWidth": 10, "ISO": 80, "GPSLatitude": 14.5}),
        json.dumps({"ImageWidth": None, "ExifImageWidth": 10, "ImageHeight": 5}), "not json",
    ]
    df = metadata_fields(spark.createDataFrame([(d,) for d in dumps], "raw string"), "raw")
    rows = df.select("datetime_original", "image_width", "image_height", "iso", "gps_latitude").collect()
    assert rows[0] == Row(datetime_original="2026:07:09 19:42:19", image_width=10, image_height=None, iso=80, gps_latitude=14.5)
    assert rows[1]["image_width"] is None and rows[1]["image_height"] == 5  # a present null wins over the fallback
    assert rows[2]["iso"] is None
    schema = T.StructType([
        T.StructField("filename", T.StringType()), T.StructField("pump", PUMP_READING), T.StructField("board", BOARD_READING),
    ])
    row = ("a", (None, None, None, "15000", "3938", True, False, ["n"]), ({}, {"v-power": "4319"}, {"super": "c.jpg"}, ["p", "q"]))
    flat = flatten_reading(spark.createDataFrame([row], schema)).first()
    assert (flat["price_vpower_raw"], flat["price_super_crop"], flat["price_vpower_gtq"], flat["board_notes"]) == ("4319", "c.jpg", None, "p;q")


def test_incremental(spark, tmp_path):
    source = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    done = spark.createDataFrame([("a", 10), ("z", 90)], "k string, v int")
    assert {r["k"] for r in unprocessed(source, done, "k").collect()} == {"b", "c"}
    assert unprocessed(source, done, "k", force=True).count() == 3
    merged = reuse_and_new(done, unprocessed(source, done, "k").select("k"), source, "k")
    assert {(r["k"], r["v"]) for r in merged.collect()} == {("a", 10), ("b", None), ("c", None)}
    manifest = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "k string, t int")
    stale = stale_only(source.withColumnRenamed("v", "changed"), manifest, "k", "changed", "t")
    assert {r["k"] for r in stale.collect()} == {"b", "c"}  # equal times count as fresh
    (tmp_path / "one.txt").write_text("x")
    assert [r["filename"] for r in file_manifest(spark, str(tmp_path), "*.txt").collect()] == ["one.txt"]


def test_writers_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', None, ["n1", "n2"])], "t string, x double, notes array<string>")
    write_csv(df, str(tmp_path / "c"))
    back = spark.read.csv(str(tmp_path / "c"), header=True, escape='"').first()
    assert back["t"] == 'a "q", b' and json.loads(back["notes"]) == ["n1", "n2"]
    write_json(df, str(tmp_path / "j"))
    assert '"x":null' in "".join(f.read_text() for f in (tmp_path / "j").glob("*.json"))
    log = append_overrides(df.select("t"), str(tmp_path / "log"))
    log = append_overrides(df.select("t"), str(tmp_path / "log"))
    assert log.count() == 2 and log.agg(F.countDistinct("recorded_at")).first()[0] == 2
