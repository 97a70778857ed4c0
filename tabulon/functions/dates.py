"""Dates and times: camera stamps, calendar parts, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a camera writes a moment, and how reports show it.
CAMERA_PATTERN = "yyyy:MM:dd HH:mm:ss"
CAMERA_SHAPE = r"^\d{4}:\d\d:\d\d \d\d:\d\d:\d\d$"
SHOW_DATE = "dd MMM yyyy"
SHOW_TIMESTAMP = "dd MMM yyyy, HH:mm"


def exif_timestamp(stamp: Column) -> Column:
    """Camera stamp to timestamp; null when malformed."""
    return F.when(stamp.rlike(CAMERA_SHAPE), F.try_to_timestamp(stamp, F.lit(CAMERA_PATTERN)))


def day_of(stamp: Column) -> Column:
    """The calendar day of a camera stamp; only its first ten characters count."""
    return F.replace(F.left(stamp, F.lit(10)), F.lit(":"), F.lit("-")).try_cast("date")


def iso_date(stamp: Column) -> Column:
    """The day of a camera stamp as yyyy-MM-dd text."""
    return F.date_format(day_of(stamp), "yyyy-MM-dd")


def calendar_columns(day: Column) -> dict[str, Column]:
    """Day name, month and weekend flag; an unknown day is not a weekend."""
    return {
        "day_of_week": F.date_format(day, "EEEE"),
        "month": F.month(day),
        "is_weekend": F.coalesce(F.weekday(day) >= 5, F.lit(False)),
    }


def show_date(moment: Column) -> Column:
    return F.date_format(moment, SHOW_DATE)


def show_timestamp(moment: Column) -> Column:
    return F.date_format(moment, SHOW_TIMESTAMP)
