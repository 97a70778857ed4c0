"""Open-schema metadata dumps and nested reading records, flattened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.text import join_notes
from tabulon.schemas import FUELS

#: Output column, tags that may carry it (first present wins), type.
METADATA_FIELDS = [
    ("datetime_original", ["DateTimeOriginal"], "string"),
    ("offset_time_original", ["OffsetTimeOriginal"], "string"),
    ("subsec_time_original", ["SubSecTimeOriginal"], "int"),
    ("gps_latitude", ["GPSLatitude"], "double"),
    ("gps_longitude", ["GPSLongitude"], "double"),
    ("gps_altitude_m", ["GPSAltitude"], "double"),
    ("gps_datetime", ["GPSDateTime"], "string"),
    ("gps_horizontal_error_m", ["GPSHPositioningError"], "double"),
    ("camera_make", ["Make"], "string"),
    ("camera_model", ["Model"], "string"),
    ("lens_model", ["LensModel"], "string"),
    ("software", ["Software"], "string"),
    ("image_width", ["ImageWidth", "ExifImageWidth"], "int"),
    ("image_height", ["ImageHeight", "ExifImageHeight"], "int"),
    ("orientation", ["Orientation"], "int"),
    ("exposure_time", ["ExposureTime"], "double"),
    ("f_number", ["FNumber"], "double"),
    ("iso", ["ISO"], "int"),
    ("focal_length_mm", ["FocalLength"], "double"),
    ("file_size_bytes", ["FileSize"], "bigint"),
]


def first_present(tags: Column, keys: list[str]) -> Column:
    """Value of the first key the map holds, even if that value is null."""
    out = F.try_element_at(tags, F.lit(keys[-1]))
    for key in reversed(keys[:-1]):
        out = F.when(F.map_contains_key(tags, key), F.try_element_at(tags, F.lit(key))).otherwise(out)
    return out


def metadata_fields(df: DataFrame, json_column: str, fields=METADATA_FIELDS) -> DataFrame:
    """Add the selected fields of a JSON dump; absent tags are null."""
    tags = F.from_json(F.col(json_column), "map<string,string>")
    with_tags = df.withColumn("_tags", tags)
    return with_tags.withColumns(
        {name: first_present(F.col("_tags"), keys).try_cast(type_) for name, keys, type_ in fields}
    ).drop("_tags")


def flatten_reading(df: DataFrame, pump: str = "pump", board: str = "board") -> DataFrame:
    """Spread the pump struct and the per-fuel board maps into one flat row.

    Board prices start empty: they are filled by the backfill, never by the reader.
    """
    kept = [F.col(c) for c in df.columns if c not in (pump, board)]
    per_fuel = []
    for fuel in FUELS:
        key = F.lit("v-power" if fuel == "vpower" else fuel)
        per_fuel += [
            F.lit(None).cast("double").alias(f"price_{fuel}_gtq"),
            F.try_element_at(F.col(f"{board}.prices_raw"), key).alias(f"price_{fuel}_raw"),
            F.try_element_at(F.col(f"{board}.crop_paths"), key).alias(f"price_{fuel}_crop"),
        ]
    return df.select(*kept, f"{pump}.*", *per_fuel, join_notes(F.col(f"{board}.notes")).alias("board_notes"))
