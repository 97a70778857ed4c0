from __future__ import annotations

import random

from pyspark.sql import functions as F

from tabulon import functions as X
from tabulon.operators.corroborate import corroborated_rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def column_of(spark, values, fn, type_="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r["o"] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_digits(spark):
    assert column_of(spark, ["Q 15,0.00", "", "abc", None], X.digits_only) == ["15000", "", "", None]
    assert column_of(spark, ["3938.0", "0938", None, "15.50", " 12.00 "], X.clean_digits) == ["3938", "0938", "", "1550", "12"]
    assert column_of(spark, ["15000", "15", "", "081829061"], X.total_from_digits) == [150.0, None, None, 818290.61]
    assert column_of(spark, ["3938", "0938", "365", "36511"], X.gallons_from_digits) == [3.938, 0.938, None, None]
    assert column_of(spark, ["4319", "431"], X.price_from_digits) == [43.19, None]


def agreed(candidates, m=3):
    """The rule restated over all pairs, as a check."""
    usable = [c for c in candidates if len(c) >= m]
    best = None
    for i, c in enumerate(usable):
        support = sum(1 for j, d in enumerate(usable) if j != i and (c.startswith(d[:m]) or d.startswith(c[:m])))
        if best is None or (support, len(c)) > best[:2]:
            best = (support, len(c), c)
    return best[2] if best and best[0] >= 1 else None


def test_pick_corroborated_matches_all_pairs_rule(spark):
    rng = random.Random(7)
    lists = [["3938", "3938", "8"], ["365", "365", "3551", "8"], []]
    lists += [["".join(rng.choice("12") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 6))] for _ in range(150)]
    got = column_of(spark, lists, lambda c: X.pick_corroborated(c), "array<string>")
    assert got == [agreed(c) for c in lists]
    rows = [(g, p, c) for g, cs in enumerate(lists) for p, c in enumerate(cs)]
    df = spark.createDataFrame(rows, "g int, p int, c string")
    by_group = {r["g"]: r["picked"] for r in corroborated_rows(df, "g", "c", "p").collect()}
    assert by_group == {g: agreed(cs) for g, cs in enumerate(lists) if cs}


def test_coercion(spark):
    assert column_of(spark, ["29.85", " 7 ", "", " ", "n/d", "NaN"], X.to_number) == [29.85, 7.0, None, None, None, None]
    days = column_of(spark, ["2024-02-29", "02/29/2024", "2024-02-29 10:00:00", "Unidades:", "2023-02-29", None], X.to_date_any)
    assert [str(d) if d else None for d in days] == ["2024-02-29"] * 3 + [None] * 3


def test_dates(spark):
    stamps = ["2026:07:26 18:11:25", "bad", None]
    assert column_of(spark, stamps, X.iso_date) == ["2026-07-26", None, None]
    assert column_of(spark, stamps, lambda c: X.show_timestamp(X.exif_timestamp(c))) == ["26 Jul 2026, 18:11", None, None]
    cal = X.calendar_columns(X.day_of(F.lit("2026:07:26 18:11:25")))
    assert [one(spark, c) for c in cal.values()] == ["Sunday", 7, True]
    assert one(spark, X.calendar_columns(F.lit(None).cast("date"))["is_weekend"]) is False


def test_numbers(spark):
    assert one(spark, X.price_per_unit(F.lit(150.0), F.lit(3.938))) == 38.0904
    for total, units in [(0.0, 1.0), (1.0, 0.0), (None, 1.0)]:
        assert one(spark, X.price_per_unit(F.lit(total).cast("double"), F.lit(units).cast("double"))) is None
    assert one(spark, X.within(F.lit(43.0), F.lit(40.0), 3.0)) is True


def test_text(spark):
    rules = [(F.lit(True), "a"), (F.lit(None).cast("boolean"), "b"), (F.lit(True), "c")]
    assert one(spark, X.join_reasons(rules)) == "a;c"
    assert one(spark, X.join_reasons([(F.lit(False), "a")])) == ""
    assert one(spark, X.money(F.lit(1234.5))) == "Q1,234.50"
    assert one(spark, X.number_or_dash(F.lit(1234.5), 3)) == "1234.500"
    assert one(spark, X.number_or_dash(F.lit(None).cast("double"), 3)) == "—"
    assert one(spark, X.address(F.lit(""), F.lit("Town"))) == "Town"
    assert column_of(spark, ["Yes", "No", "?"], lambda c: X.map_labels(c, {"Yes": 1, "No": 0})) == [1, 0, None]
    assert column_of(spark, [["a", "b"], []], X.join_notes, "array<string>") == ["a;b", ""]
