"""Small numeric rules shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals kept in unit prices and in coordinate keys (about 11 m).
UNIT_PRICE_DECIMALS = 4
COORDINATE_DECIMALS = 4


def price_per_unit(total: Column, units: Column) -> Column:
    """Rounded ratio; null when either side is null or zero."""
    return F.round(
        F.try_divide(F.nullif(total, F.lit(0.0)), F.nullif(units, F.lit(0.0))), UNIT_PRICE_DECIMALS
    )


def within(a: Column, b: Column, tolerance: float) -> Column:
    """Whether two values differ by at most the tolerance."""
    return F.abs(a - b) <= F.lit(tolerance)


def relative_deviation(value: Column, centre: Column) -> Column:
    return F.try_divide(F.abs(value - centre), centre)


def round_coordinate(degrees: Column) -> Column:
    return F.round(degrees, COORDINATE_DECIMALS)
