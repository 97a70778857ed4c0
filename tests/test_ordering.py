from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tabulon.operators.dashboard import chart_series, headline, latest_confirmed_board, pending_counts
from tabulon.operators.ordering import (
    CELL, cells_for, chronological, every_nth, first_per_key, head, newest_first, with_cell, with_position, with_previous,
)
from tabulon.operators.features import lag_features
from tabulon.operators.clean import clean_customers, keep_plausible
from tabulon.schemas import BOARD_PRICES, CHURN


def log_rows(seed=5, n=400):
    """One entity holds most rows, times are bursty, some are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        entity = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
        at = None if rng.random() < 0.05 else rng.choice([rng.randint(0, 50), rng.randint(0, 10**6)])
        rows.append((entity, at, i, rng.choice([None, float(i)])))
    return rows


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2]))


@pytest.mark.parametrize("rows_per_cell", [1, 7, 60, 10**6])
@pytest.mark.parametrize("entity", [["e"], []])
def test_previous_crosses_cells(spark, rows_per_cell, entity):
    rows = log_rows()
    df = spark.createDataFrame(rows, "e string, at long, id int, v double").repartition(4)
    got = with_previous(df, {"pv": F.col("v"), "pid": F.col("id")}, ["at", "id"], entity, rows_per_cell)
    assert got.columns == ["e", "at", "id", "v", "pv", "pid"]
    want, last = {}, {}
    for e, _, i, v in ordered(rows):
        key = e if entity else ""
        want[i] = last.get(key, (None, None))
        last[key] = (v, i)
    assert {r["id"]: (r["pv"], r["pid"]) for r in got.collect()} == want


@pytest.mark.parametrize("rows_per_cell", [3, 10**6])
def test_positions_and_ticks(spark, rows_per_cell):
    rows = log_rows(9)
    df = spark.createDataFrame(rows, "e string, at long, id int, v double").repartition(3)
    got = with_position(df, ["at", "id"], ["e"], rows_per_cell, {"max_v": F.max("v")})
    seen, sizes = {}, {}
    for e, _, i, _ in ordered(rows):
        seen[i] = sizes.get(e, 0)
        sizes[e] = seen[i] + 1
    collected = got.collect()
    assert {r["id"]: (r["position"], r["series_rows"]) for r in collected} == {
        i: (p, sizes[e]) for e, _, i, _ in rows for p in [seen[i]]
    }
    ticks = {r["id"] for r in every_nth(got).collect()}
    assert ticks == {i for e, _, i, _ in rows if seen[i] % max(1, sizes[e] // 5) == 0}


@pytest.mark.parametrize("entity", [["user"], []])
def test_malformed_stamps_do_not_depend_on_cells(spark, entity):
    stamps = ["2024:01:01 10:00:00", "2024:01:05 10:00:00", "2024:01:06", "2024:01:07 09:00:00", None, "bad",
              "2024:01:09 10:00:00"]
    rows = [("u", f"f{i}", s, float(40 + i)) for i, s in enumerate(stamps)]
    df = spark.createDataFrame(rows, "user string, filename string, datetime_original string, price_per_gallon_gtq double")
    one, two, many = (
        {r["filename"]: tuple(r[-3:]) for r in lag_features(df, entity=entity, rows_per_cell=n).collect()}
        for n in (1000, 2, 1)
    )
    assert one == two == many
    assert one["f2"][:2] == (1, 1.0) and one["f3"][:2] == (1, 1.0)


@pytest.mark.parametrize("kind", ["outlier", "nulls"])
def test_cells_stay_even(spark, kind):
    at = F.when(F.col("id") == 0, 10**12).otherwise(F.col("id") % 50) if kind == "outlier" else F.when(F.col("id") >= 18_000, F.col("id"))
    df = spark.range(20_000).select(F.lit("hot").alias("e"), at.cast("long").alias("at"), "id").repartition(8)
    cells = cells_for(df, 1000)
    cut = with_cell(df, cells, ["at", "id"], ["e"]).groupBy(CELL).count().collect()
    assert cells == 20 and len(cut) == 20 and max(r["count"] for r in cut) <= 2000
    assert sum(r["count"] for r in cut) == 20_000


def test_orders(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    assert [r["v"] for r in chronological(df, "k").collect()] == ["a", "c", "b"]
    assert [r["v"] for r in newest_first(df, "k").collect()] == ["c", "a", "b"]
    assert [r["v"] for r in head(df, 1, "k").collect()] == ["a"]
    assert "TakeOrderedAndProject" in head(df, 1, "k")._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_limits_before_shuffling(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    kept = first_per_key(df, ["k"], [F.col("v").desc()])
    assert {(r["k"], r["v"]) for r in kept.collect()} == {(0, 999), (1, 997), (2, 998)}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_range_is_tested_after_dedup(spark):
    df = spark.createDataFrame([("a", -1, 0), ("a", 5, 1), ("b", 0, 2), ("c", 100, 3), ("d", 101, 4), ("e", None, 5)], "k string, t int, o int")
    kept = keep_plausible(df, "k", "t", 0, 100, [F.col("o")])
    assert kept.columns == ["t", "o"] and {r["t"] for r in kept.collect()} == {0, 100}


def test_missing_columns_are_all_named(spark):
    df = spark.createDataFrame([], CHURN).drop("tenure", "Contract")
    with pytest.raises(KeyError, match="tenure.*Contract"):
        clean_customers(df)


def test_report_figures(spark):
    schema = ("filename string, datetime_original string, price_per_gallon_gtq double, gallons double, parse_ok boolean, "
              "data_source string, needs_review boolean, board_needs_review boolean")
    rows = [("a", "2026:01:03 00:00:00", 42.0, 3.5, True, "ocr", False, True),
            ("b", "2026:01:01 00:00:00", 40.0, 3.7, True, "manual_override", True, False),
            ("c", "2026:01:04 00:00:00", None, None, False, "ocr", True, True)]
    df = spark.createDataFrame(rows, schema)
    h = headline(df).first()
    assert (h["first_price"], h["latest_price"], h["delta"], h["trend"], h["mean_price"]) == (40.0, 42.0, 2.0, "up", 41.0)
    assert (h["delta_pct"], h["n_total"], h["n_auto"], h["n_reviewed"], h["latest_gallons"]) == (5.0, 3, 2, 1, 3.5)
    assert pending_counts(df).first().asDict() == {"n_pending": 1, "n_board_pending": 2}
    series = {r["filename"]: r for r in chart_series(df).collect()}
    assert set(series) == {"a", "b"} and (series["a"]["axis_low"], series["a"]["axis_high"]) == (39.0, 43.0)
    assert (series["b"]["x"], series["b"]["y"], series["a"]["x"]) == (0.0, 0.75, 1.0)
    assert chart_series(df.filter("filename = 'a'")).count() == 0
    board = df.select("filename", "datetime_original", *[F.col("price_per_gallon_gtq").alias(c) for c in BOARD_PRICES])
    assert latest_confirmed_board(board).first()["filename"] == "a"


def test_cells_of_a_large_table_stay_small(spark):
    rows = spark.range(600_000).select(((F.col("id") * 7919) % 600_000).alias("at"), F.lit("hot").alias("who"))
    cells = with_cell(rows, cells_for(rows), ["at"], ["who"]).groupBy(CELL).count().collect()
    assert max(r["count"] for r in cells) < 400_000 and sum(r["count"] for r in cells) == 600_000
    gaps = with_previous(rows, {"before": F.col("at")}, ["at"], ["who"]).select((F.col("at") - F.col("before")).alias("gap"))
    assert {r["gap"]: r["count"] for r in gaps.groupBy("gap").count().collect()} == {None: 1, 1: 599_999}
