"""Declared schemas of every source. Nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names of the input files and the model's column roles.
# ---------------------------------------------------------------------------
CUSTOMER_ID = "customerID"
CHURN_TARGET = "Churn"
TENURE = "tenure"
CHURN_NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"]
CHURN_CATEGORICAL = [
    "gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
    "PaperlessBilling", "PaymentMethod",
]
CHURN_FEATURES = CHURN_NUMERIC + CHURN_CATEGORICAL

FUELS = ["diesel", "regular", "super", "vpower"]
BOARD_PRICES = [f"price_{fuel}_gtq" for fuel in FUELS]
GEO_FIELDS = [
    "display_name", "station_name", "road", "neighbourhood", "city",
    "county", "state", "country", "postcode",
]
OFFICIAL_PRICES = [
    "exchange_rate_usd_gtq", "official_super_gtq", "official_regular_gtq", "official_diesel_gtq",
]
FOOD_NAME = "food"
FOOD_INDEX_COLUMNS = ["Unnamed: 0.1", "Unnamed: 0"]
# ---------------------------------------------------------------------------


def _fields(type_: T.DataType, names: list[str]) -> list[T.StructField]:
    return [T.StructField(name, type_) for name in names]


_TEXT, _NUMBER, _INT, _FLAG = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

#: TotalCharges stays text here: the source has blanks, coerced during extraction.
CHURN = T.StructType(
    _fields(_TEXT, [CUSTOMER_ID])
    + _fields(_INT, ["tenure"])
    + _fields(_NUMBER, ["MonthlyCharges"])
    + _fields(_TEXT, ["TotalCharges"])
    + _fields(_INT, ["SeniorCitizen"])
    + _fields(_TEXT, CHURN_CATEGORICAL + [CHURN_TARGET])
)

#: What a reader of photos hands over; digit strings are text so zeros survive.
READINGS = T.StructType(
    _fields(_TEXT, ["filename", "datetime_original", "offset_time_original"])
    + _fields(_INT, ["subsec_time_original"])
    + _fields(_NUMBER, ["gps_latitude", "gps_longitude", "gps_altitude_m"])
    + _fields(_TEXT, ["gps_datetime"])
    + _fields(_NUMBER, ["gps_horizontal_error_m"])
    + _fields(_TEXT, ["camera_make", "camera_model", "lens_model", "software"])
    + _fields(_INT, ["image_width", "image_height", "orientation"])
    + _fields(_NUMBER, ["exposure_time", "f_number"])
    + _fields(_INT, ["iso"])
    + _fields(_NUMBER, ["focal_length_mm"])
    + _fields(T.LongType(), ["file_size_bytes"])
    + _fields(_TEXT, ["total_raw", "gallons_raw"])
    + _fields(_FLAG, ["anchors_found"])
    + _fields(_TEXT, ["notes"])
    + _fields(_TEXT, [f"price_{f}_raw" for f in FUELS] + [f"price_{f}_crop" for f in FUELS])
    + _fields(_TEXT, ["board_notes"])
    + _fields(_TEXT, [f"geo_{name}" for name in GEO_FIELDS])
)

#: The flattened record of one pump display reading, before file-level fields join it.
PUMP_READING = T.StructType(
    _fields(_NUMBER, ["total_gtq", "gallons", "price_per_gallon_gtq"])
    + _fields(_TEXT, ["total_raw", "gallons_raw"])
    + _fields(_FLAG, ["anchors_found", "parse_ok"])
    + [T.StructField("notes", T.ArrayType(T.StringType()))]
)

#: The four board displays as maps keyed by fuel.
BOARD_READING = T.StructType([
    T.StructField("prices_gtq", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("prices_raw", T.MapType(T.StringType(), T.StringType())),
    T.StructField("crop_paths", T.MapType(T.StringType(), T.StringType())),
    T.StructField("notes", T.ArrayType(T.StringType())),
])

READING_OVERRIDES = T.StructType(
    _fields(_TEXT, ["filename"])
    + _fields(_NUMBER, ["total_gtq", "gallons"])
    + _fields(_TEXT, ["override_note"])
)

BOARD_OVERRIDES = T.StructType(
    _fields(_TEXT, ["filename"]) + _fields(_NUMBER, BOARD_PRICES) + _fields(_TEXT, ["note"])
)

OFFICIAL = T.StructType([T.StructField("date", T.DateType())] + _fields(_NUMBER, OFFICIAL_PRICES))

PLACES = T.StructType(_fields(_NUMBER, ["lat4", "lon4"]) + _fields(_TEXT, GEO_FIELDS))
