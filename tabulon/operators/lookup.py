"""Keyed lookups as left joins.

None carries a broadcast hint: dimension sizes are not known here, so the choice
between broadcast and shuffled join is left to measured sizes, and a hot key on
the large side to skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numbers import round_coordinate
from tabulon.schemas import GEO_FIELDS, OFFICIAL_PRICES


def official_on_day(df: DataFrame, official: DataFrame, day: Column, found: str | None = None) -> DataFrame:
    """Same-day reference prices; no row for the day gives nulls.

    ``found`` optionally names a flag telling whether the day is published at all.
    """
    flag = [F.lit(True).alias(found)] if found else []
    reference = official.select(F.col("date").alias("_day"), *OFFICIAL_PRICES, *flag)
    joined = df.withColumn("_key", day).join(reference, F.col("_key") == F.col("_day"), "left")
    out = joined.drop("_key", "_day")
    return out.withColumn(found, F.coalesce(F.col(found), F.lit(False))) if found else out


def place_city(city: Column, town: Column, village: Column) -> Column:
    """City, or else town, or else village; empty text counts as absent."""
    blank = F.lit("")
    return F.coalesce(F.nullif(city, blank), F.nullif(town, blank), village)


def _located(df: DataFrame, lat: str, lon: str) -> DataFrame:
    usable = (F.col(lat) != 0) & (F.col(lon) != 0)
    return df.withColumns({
        "_lat4": F.when(usable, round_coordinate(F.col(lat))),
        "_lon4": F.when(usable, round_coordinate(F.col(lon))),
    })


def locate(
    df: DataFrame, places: DataFrame, lat: str = "gps_latitude", lon: str = "gps_longitude",
    fields: Sequence[str] = GEO_FIELDS,
) -> DataFrame:
    """Add ``geo_*`` columns from the place whose rounded coordinates match.

    A zero coordinate counts as missing.
    """
    target = places.select("lat4", "lon4", *[F.col(f).alias(f"geo_{f}") for f in fields])
    keyed = _located(df, lat, lon)
    on = (F.col("_lat4") == F.col("lat4")) & (F.col("_lon4") == F.col("lon4"))
    return keyed.join(target, on, "left").drop("_lat4", "_lon4", "lat4", "lon4")


def unknown_places(
    df: DataFrame, places: DataFrame, lat: str = "gps_latitude", lon: str = "gps_longitude"
) -> DataFrame:
    """Distinct rounded coordinates no place covers yet: the work list for a geocoder."""
    keys = _located(df, lat, lon).select(F.col("_lat4").alias("lat4"), F.col("_lon4").alias("lon4"))
    return keys.na.drop().distinct().join(places.select("lat4", "lon4"), ["lat4", "lon4"], "left_anti")
