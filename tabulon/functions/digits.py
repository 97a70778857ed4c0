"""Reading numbers out of display digits that lost their decimal point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits a total needs, and the exact width of the other displays.
TOTAL_MIN_DIGITS = 3
UNIT_DIGITS = 4
TOTAL_SCALE, GALLONS_SCALE, PRICE_SCALE = 100, 1000, 100


def digits_only(text: Column) -> Column:
    """All digit characters, in order."""
    return F.regexp_replace(text, "[^0-9]", "")


def clean_digits(raw: Column) -> Column:
    """Digits of a raw reading; null gives '', a round-tripped ``3938.0`` gives ``3938``."""
    whole = F.when(raw.contains("."), F.regexp_replace(raw, r"^\s*(-?\d+)\.0+\s*$", "$1")).otherwise(raw)
    return digits_only(F.coalesce(whole, F.lit("")))


def _scaled(digits: Column, long_enough: Column, scale: int) -> Column:
    return F.when(long_enough, digits.try_cast("double") / F.lit(float(scale)))


def total_from_digits(digits: Column) -> Column:
    """Amount whose last two digits are cents; null below three digits."""
    return _scaled(digits, F.length(digits) >= TOTAL_MIN_DIGITS, TOTAL_SCALE)


def gallons_from_digits(digits: Column) -> Column:
    """d.ddd volume; null unless exactly four digits."""
    return _scaled(digits, F.length(digits) == UNIT_DIGITS, GALLONS_SCALE)


def price_from_digits(digits: Column) -> Column:
    """dd.dd price; null unless exactly four digits."""
    return _scaled(digits, F.length(digits) == UNIT_DIGITS, PRICE_SCALE)


def pick_corroborated(candidates: Column, min_len: int = 3) -> Column:
    """The candidate most other candidates agree with on the first ``min_len`` digits.

    Longer wins among equals, then the earlier one; null when nobody agrees.
    Two candidates agree exactly when their leading ``min_len`` characters match,
    so a histogram of those prefixes gives each candidate its support.
    """
    def prefix(c: Column) -> Column:
        return F.left(c, F.lit(min_len))

    usable = F.filter(candidates, lambda c: F.length(c) >= min_len)
    prefixes = F.transform(usable, prefix)
    ranked = F.transform(
        usable,
        lambda c, i: F.struct(
            (F.size(F.filter(prefixes, lambda p: p == prefix(c))) - 1).alias("support"),
            F.length(c).alias("digits"),
            (-i).alias("earlier"),
            c.alias("value"),
        ),
    )
    best = F.array_max(ranked)
    return F.when(best["support"] >= 1, best["value"])
