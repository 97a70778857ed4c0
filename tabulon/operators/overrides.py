"""Human corrections over machine readings, and the price board backfill.

Every run starts again from the raw digit columns, so applying corrections twice
equals applying them once, and a withdrawn correction leaves no trace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.dates import day_of
from tabulon.functions.digits import clean_digits, gallons_from_digits, price_from_digits, total_from_digits
from tabulon.functions.numbers import price_per_unit, within
from tabulon.operators.lookup import official_on_day
from tabulon.operators.ordering import first_per_key
from tabulon.operators.select import stack, without_keys
from tabulon.schemas import BOARD_PRICES, FUELS, OFFICIAL_PRICES

#: Provenance tags, anchor tolerance, fuels with a public reference.
SOURCE_READER, SOURCE_HUMAN = "ocr", "manual_override"
BOARD_OFFICIAL, BOARD_AUTO, BOARD_OPEN, BOARD_HUMAN = "auto+official_mem", "auto", "unconfirmed", "manual"
BOARD_TOLERANCE = 3.0
ANCHOR_FUEL = "super"
OFFICIAL_COLUMN = {"diesel": "official_diesel_gtq", "regular": "official_regular_gtq"}


def reading_baseline(df: DataFrame) -> DataFrame:
    """Total, gallons, unit price and status, from the raw digits alone.

    A zero total still parses; zero gallons do not.
    """
    return df.withColumns({
        "total_gtq": total_from_digits(clean_digits(F.col("total_raw"))),
        "gallons": gallons_from_digits(clean_digits(F.col("gallons_raw"))),
    }).withColumns({
        "price_per_gallon_gtq": price_per_unit(F.col("total_gtq"), F.col("gallons")),
        "parse_ok": F.col("total_gtq").isNotNull() & (F.coalesce(F.col("gallons"), F.lit(0.0)) != 0),
        "data_source": F.lit(SOURCE_READER),
        "override_note": F.lit(""),
    })


def latest_overrides(overrides: DataFrame, key: str, sequence: Sequence[str]) -> DataFrame:
    """The last correction of each key; ``sequence`` columns give the order of entry."""
    return first_per_key(overrides, [key], [F.col(c).desc() for c in sequence]).drop(*sequence)


def upsert_overrides(existing: DataFrame, new_rows: DataFrame, key: str) -> DataFrame:
    """Replace any existing corrections of the new rows' keys."""
    return stack(without_keys(existing, new_rows, key), new_rows)


def split_valid(overrides: DataFrame, positive: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): every column in ``positive`` has to be above zero."""
    ok = F.lit(True)
    for c in positive:
        ok = ok & F.coalesce(F.col(c) > 0, F.lit(False))
    return overrides.filter(ok), overrides.filter(~ok)


def _overlay(df: DataFrame, overrides: DataFrame, key: str, replaced: dict[str, Column]) -> DataFrame:
    """Left join on the key; matched rows take ``replaced``, even where it is null."""
    side = overrides.select(
        F.col(key).alias("_key"), *[value.alias(f"_new_{name}") for name, value in replaced.items()]
    )
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    matched = F.col("_key").isNotNull()
    return joined.withColumns(
        {name: F.when(matched, F.col(f"_new_{name}")).otherwise(F.col(name)) for name in replaced}
    ).drop("_key", *[f"_new_{name}" for name in replaced])


def apply_reading_overrides(df: DataFrame, overrides: DataFrame, key: str = "filename") -> DataFrame:
    """Baseline, then corrections (one per key); keys unknown to ``df`` are ignored."""
    return _overlay(reading_baseline(df), overrides, key, {
        "total_gtq": F.col("total_gtq"),
        "gallons": F.col("gallons"),
        "price_per_gallon_gtq": price_per_unit(F.col("total_gtq"), F.col("gallons")),
        "parse_ok": F.lit(True),
        "data_source": F.lit(SOURCE_HUMAN),
        "override_note": F.col("override_note"),
    })


def board_baseline(df: DataFrame, official: DataFrame) -> DataFrame:
    """Board prices without human help, and where they came from.

    The anchor fuel takes the price paid. Others take their own reading when it is
    close enough to the anchor, else the same-day reference where one is published,
    else nothing. Using the reference is decided by the day being published, not by
    its price being known.
    """
    joined = official_on_day(df, official, day_of(F.col("datetime_original")), found="_published")
    anchor = F.col("price_per_gallon_gtq")
    others = [f for f in FUELS if f != ANCHOR_FUEL]
    # Parsed and compared in steps of their own: each digit string is read once.
    joined = joined.withColumns(
        {f"_own_{f}": price_from_digits(clean_digits(F.col(f"price_{f}_raw"))) for f in others}
    ).withColumns(
        {f"_close_{f}": F.coalesce(within(F.col(f"_own_{f}"), anchor, BOARD_TOLERANCE), F.lit(False)) for f in others}
    )
    prices, used = {f"price_{ANCHOR_FUEL}_gtq": anchor}, F.lit(False)
    for fuel in others:
        close = F.col(f"_close_{fuel}")
        price = F.when(close, F.col(f"_own_{fuel}"))
        if fuel in OFFICIAL_COLUMN:
            fallback = ~close & F.col("_published")
            price = price.when(fallback, F.col(OFFICIAL_COLUMN[fuel]))
            used = used | fallback
        prices[f"price_{fuel}_gtq"] = price
    origin = (
        F.when(used, F.lit(BOARD_OFFICIAL)).when(anchor.isNotNull(), F.lit(BOARD_AUTO)).otherwise(F.lit(BOARD_OPEN))
    )
    filled = joined.withColumns({**prices, "board_data_source": origin, "board_override_note": F.lit("")})
    steps = [f"{step}_{f}" for step in ("_own", "_close") for f in others]
    return filled.drop("_published", *steps, *OFFICIAL_PRICES)


def apply_board_overrides(
    df: DataFrame, official: DataFrame, overrides: DataFrame, key: str = "filename"
) -> DataFrame:
    """Backfilled board, then human board readings (one per key)."""
    return _overlay(board_baseline(df, official), overrides, key, {
        **{c: F.col(c) for c in BOARD_PRICES},
        "board_data_source": F.lit(BOARD_HUMAN),
        "board_override_note": F.col("note"),
    })
