"""Column functions: each takes columns and returns a column, all JVM-side."""

from tabulon.functions.coerce import missing_to_null, to_number
from tabulon.functions.dates import (
    calendar_columns, day_of, exif_timestamp, iso_date, show_date, show_timestamp,
)
from tabulon.functions.digits import (
    clean_digits, digits_only, gallons_from_digits, pick_corroborated, price_from_digits, total_from_digits,
)
from tabulon.functions.mixed_dates import date_rejects, read_date, to_date_any
from tabulon.functions.numbers import price_per_unit, relative_deviation, round_coordinate, within
from tabulon.functions.text import (
    address, badge, has_note, join_notes, join_reasons, map_labels, money, number_or_dash, pending_label,
)

__all__ = [
    "address", "badge", "calendar_columns", "clean_digits", "date_rejects", "day_of", "digits_only", "exif_timestamp",
    "gallons_from_digits", "has_note", "iso_date", "join_notes", "join_reasons", "map_labels",
    "missing_to_null", "money", "number_or_dash", "pending_label", "pick_corroborated", "price_from_digits",
    "price_per_unit", "read_date", "relative_deviation", "round_coordinate", "show_date", "show_timestamp", "to_date_any",
    "to_number", "total_from_digits", "within",
]
