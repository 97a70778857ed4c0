"""The reading log end to end: golden rows, override rules, idempotence."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabulon.operators.features import NOT_PUBLIC, public_export
from tabulon.operators.flags import flag_board, flag_readings, review_queue
from tabulon.operators.overrides import (
    apply_board_overrides, apply_reading_overrides, latest_overrides, reading_baseline, split_valid, upsert_overrides,
)
from tabulon.plans.reading_log import ReadingLogPaths, derive_log, publish_official, refresh, save_override
from tabulon.schemas import BOARD_OVERRIDES, OFFICIAL, READING_OVERRIDES, READINGS
from tabulon.sources import write_csv

# Five real readings, two corrections, reference prices of their days.
FILLS = [
    ("IMG_8271.HEIC", "2026:07:09 19:42:19", "15000", "3938", None),
    ("IMG_8286.HEIC", "2026:07:15 19:57:16", "15000", "3789", None),
    ("IMG_8304.HEIC", "2026:07:22 21:50:33", "15000", None, "611211913699801"),
    ("IMG_8322.HEIC", "2026:07:26 18:11:25", "15000", None, None),
    ("IMG_8325.HEIC", "2026:07:30 20:00:51", "15000", "3564", None),
]
CORRECTIONS = [("IMG_8304.HEIC", 150.0, 3.651, "seen"), ("IMG_8322.HEIC", 150.0, 3.564, "glare")]
REFERENCE = [
    ("2026-07-09", 7.62129, 37.01, 36.01, 35.17), ("2026-07-15", 7.61989, 39.06, 38.07, 37.58),
    ("2026-07-22", 7.62466, 41.07, 40.07, 42.26), ("2026-07-26", 7.62581, 41.07, 40.07, 42.26),
    ("2026-07-30", 7.62552, 42.03, 41.03, 43.72),
]
EXPECTED = [
    # price, diesel, regular, day name, weekend, days, change, percent, markup
    (38.0904, 35.17, 36.01, "Thursday", False, None, None, None, 1.0804),
    (39.5883, 37.58, 38.07, "Wednesday", False, 6, 1.4979, 3.9324869, 0.5283),
    (41.0846, 42.26, 40.07, "Wednesday", False, 7, 1.4963, 3.7796521, 0.0146),
    (42.0875, 42.26, 40.07, "Sunday", True, 4, 1.0029, 2.4410606, 1.0175),
    (42.0875, 43.72, 41.03, "Thursday", False, 4, 0.0, 0.0, 0.0575),
]


def readings(spark, rows=FILLS):
    base = {f.name: None for f in READINGS}
    out = [
        tuple({**base, "filename": n, "datetime_original": d, "total_raw": t, "gallons_raw": g, "price_diesel_raw": p,
               "notes": "[]"}.values()) for n, d, t, g, p in rows
    ]
    return spark.createDataFrame(out, READINGS)


def corrections(spark, rows=CORRECTIONS):
    return spark.createDataFrame(rows, READING_OVERRIDES)


def reference(spark):
    text = spark.createDataFrame(REFERENCE, "date string, a double, b double, c double, d double")
    return text.select(F.col("date").cast("date"), *[F.col(c).alias(n) for c, n in zip("abcd", OFFICIAL.names[1:])])


def no_board(spark):
    return spark.createDataFrame([], BOARD_OVERRIDES)


@pytest.mark.parametrize("partitions,rows_per_cell", [(1, 10**6), (4, 1)])
def test_golden_export(spark, partitions, rows_per_cell):
    log = derive_log(
        readings(spark).repartition(partitions), corrections(spark), no_board(spark), reference(spark), notes_are_array=False
    )
    rows = public_export(log, reference(spark), rows_per_cell=rows_per_cell).orderBy("datetime_original").collect()
    assert len(rows[0]) == 19 and len(NOT_PUBLIC) == 52
    for r, want in zip(rows, EXPECTED):
        got = (
            r["price_per_gallon_gtq"], r["price_diesel_gtq"], r["price_regular_gtq"], r["day_of_week"], r["is_weekend"],
            r["days_since_previous_fill"], r["price_change_gtq"], r["price_change_pct"], r["station_markup_super_gtq"],
        )
        assert got == tuple(pytest.approx(w, abs=1e-6) if isinstance(w, float) else w for w in want)
        assert r["price_super_gtq"] == r["price_per_gallon_gtq"] and r["price_vpower_gtq"] is None
    state = log.select("data_source", "needs_review", "board_data_source", "board_needs_review").collect()
    assert {tuple(s) for s in state} == {
        ("ocr", False, "auto+official_mem", True), ("manual_override", False, "auto+official_mem", True),
    }


def test_baseline_rules(spark):
    rows = readings(spark, [("z", "d", "000", "3938", None), ("g", "d", "15000", "0000", None), ("n", "d", None, None, None),
                            ("short", "d", "15000", "938", None)])
    got = {r["filename"]: (r["total_gtq"], r["gallons"], r["price_per_gallon_gtq"], r["parse_ok"])
           for r in reading_baseline(rows).collect()}
    assert got == {
        "z": (0.0, 3.938, None, True),  # a zero total parses but has no unit price
        "g": (150.0, 0.0, None, False), "n": (None, None, None, False), "short": (150.0, None, None, False),
    }


def test_override_rules(spark):
    log = spark.createDataFrame(
        [("a", 150.0, 3.0, "one", 1), ("a", 150.0, None, "two", 2), ("unknown", 1.0, 1.0, "", 1)],
        "filename string, total_gtq double, gallons double, override_note string, seq int",
    )
    last = latest_overrides(log, "filename", ["seq"])
    rows = readings(spark, [("a", "d", "15000", "3938", None), ("b", "d", "15000", "3938", None)])
    got = {r["filename"]: r for r in apply_reading_overrides(rows, last).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["gallons"], got["a"]["price_per_gallon_gtq"], got["a"]["parse_ok"]) == (None, None, True)
    assert got["a"]["override_note"] == "two" and got["b"]["data_source"] == "ocr"
    again = apply_reading_overrides(apply_reading_overrides(rows, last), last)
    assert sorted(again.collect(), key=str) == sorted(apply_reading_overrides(rows, last).collect(), key=str)
    withdrawn = apply_reading_overrides(apply_reading_overrides(rows, last), last.limit(0)).filter("filename = 'a'").first()
    assert withdrawn["gallons"] == 3.938 and withdrawn["data_source"] == "ocr"


def test_upsert_and_validity(spark):
    old, new = corrections(spark), corrections(spark, [("IMG_8304.HEIC", 150.0, 3.7, "better"), ("x", 1.0, 0.0, "bad")])
    good, bad = split_valid(new, ["gallons"])
    assert [r["filename"] for r in bad.collect()] == ["x"]
    merged = {r["filename"]: r["gallons"] for r in upsert_overrides(old, good, "filename").collect()}
    assert merged == {"IMG_8304.HEIC": 3.7, "IMG_8322.HEIC": 3.564}


def test_board_rules(spark):
    day = "2026:07:09 10:00:00"
    rows = [
        ("own", day, "15000", "3938", "3600"),       # 36.00 lies within 3 of 38.09
        ("far", day, "15000", "3938", "7719"),       # misread, so the reference
        ("unread", day, "15000", None, "3600"),      # no anchor: the reference still applies
        ("noday", "2020:01:01 10:00:00", "15000", "3938", None),
        ("nothing", None, None, None, None),
    ]
    gap = reference(spark).withColumn("official_diesel_gtq", F.lit(None).cast("double"))
    base = apply_reading_overrides(readings(spark, rows), corrections(spark, []))
    got = {r["filename"]: (r["price_diesel_gtq"], r["price_regular_gtq"], r["board_data_source"])
           for r in apply_board_overrides(base, gap, no_board(spark)).collect()}
    assert got == {
        "own": (36.0, 36.01, "auto+official_mem"), "far": (None, 36.01, "auto+official_mem"),
        "unread": (None, 36.01, "auto+official_mem"), "noday": (None, None, "auto"), "nothing": (None, None, "unconfirmed"),
    }
    human = spark.createDataFrame([("own", 1.0, 2.0, None, 4.0, "seen")], BOARD_OVERRIDES)
    row = apply_board_overrides(base, gap, human).filter("filename = 'own'").first()
    assert (row["price_super_gtq"], row["price_vpower_gtq"], row["board_data_source"]) == (None, 4.0, "manual")
    assert flag_board(apply_board_overrides(base, gap, human)).filter("NOT board_needs_review").count() == 0


def test_flag_rules(spark):
    schema = "filename string, total_gtq double, price_per_gallon_gtq double, parse_ok boolean, data_source string, notes array<string>"
    note = "total_assumed_default_not_confirmed_by_ocr"
    rows = [("a", 150.0, 40.0, True, "ocr", []), ("b", 150.01, 41.0, True, "ocr", ["x"]), ("c", 149.0, 80.0, True, "ocr", []),
            ("d", None, None, False, "ocr", [note]), ("e", 150.0, 42.0, True, "manual_override", [note])]
    got = {r["filename"]: r["review_reason"] for r in flag_readings(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": "", "b": "", "c": "total_not_150gtq;price_deviates_from_median",
                   "d": "ocr_parse_failed;total_assumed_not_confirmed_by_ocr", "e": ""}
    few = flag_readings(spark.createDataFrame([rows[0], rows[2], rows[3]], schema))
    assert {r["review_reason"] for r in few.collect()} == {"", "total_not_150gtq", got["d"]}  # two valid rows: no median
    assert review_queue(few).count() == 2


def test_publish_official(spark, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text(
        "Precios,,,,\nFECHA, Tipo de Cambio ,Gasolina Superior,Gasolina Regular,Aceite Combustible Diésel\n"
        "Unidades:,,GTQ,GTQ,GTQ\n2026-07-09,7.6,1,2,3\n2026-07-09,7.7,4,5,6\n2020-01-01,7,1,1,1\n"
    )
    rows = publish_official(spark, str(sheet), str(tmp_path / "out")).collect()
    assert [(str(r["date"]), r["exchange_rate_usd_gtq"], r["official_diesel_gtq"]) for r in rows] == [("2026-07-09", 7.7, 6.0)]


def test_refresh_is_idempotent_and_overrides_persist(spark, tmp_path):
    def paths(run):
        return ReadingLogPaths(*[str(tmp_path / p) for p in ("ov", "none", "ref", f"data{run}", f"json{run}", f"pub{run}")])

    write_csv(corrections(spark), str(tmp_path / "ov"))
    write_csv(reference(spark), str(tmp_path / "ref"))
    first = refresh(spark, readings(spark), paths(1), notes_are_array=False)
    second = refresh(spark, first, paths(2), notes_are_array=False)
    assert second.columns == first.columns or set(second.columns) == set(first.columns)
    order = sorted(first.columns)
    assert [tuple(r[c] for c in order) for r in first.orderBy("filename").collect()] == [
        tuple(r[c] for c in order) for r in second.orderBy("filename").collect()
    ]
    public = spark.read.csv(str(tmp_path / "pub2"), header=True)
    assert len(public.columns) == 19 and public.count() == 5
    assert spark.read.json(str(tmp_path / "json2")).count() == 5
    saved = save_override(spark, corrections(spark, [("IMG_8271.HEIC", 150.0, 4.0, "now")]), str(tmp_path / "ov"), str(tmp_path / "ov2"))
    assert saved.count() == 3
