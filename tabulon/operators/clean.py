"""Row cleaning: duplicates, plausible ranges, published reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.coerce import to_number
from tabulon.functions.mixed_dates import date_rejects, read_date
from tabulon.operators.ordering import first_per_key
from tabulon.operators.select import extract_columns
from tabulon.schemas import CHURN_FEATURES, CHURN_TARGET, CUSTOMER_ID, OFFICIAL_PRICES, TENURE
from tabulon.sources.file_order import is_scan, place_in_files

#: Plausible tenure in months, first day of the reference series.
TENURE_RANGE = (0, 100)
FIRST_OFFICIAL_DAY = "2021-01-01"


def keep_plausible(
    df: DataFrame,
    key: str,
    measure: str,
    low: float,
    high: float,
    order: Sequence[Column],
) -> DataFrame:
    """First row per key, then rows whose measure lies in [low, high]; the key is dropped.

    The range is tested after de-duplication: a bad first row still hides later
    rows of its key. A null measure fails.
    """
    return first_per_key(df, [key], order).filter(F.col(measure).between(low, high)).drop(key)


def clean_customers(raw: DataFrame, order: Sequence[Column] | None = None, features: Sequence[str] = CHURN_FEATURES,
                    include_target: bool = True) -> DataFrame:
    """Extraction plus filtering of a customer export.

    ``order`` says which duplicate comes first. Without it the rows must come from a file scan, and the one
    delivered first counts: by path, then by place in the file.
    """
    target = CHURN_TARGET if include_target else None
    extract_columns(raw, CUSTOMER_ID, features, target)  # names absent columns first; no job
    if order is None:
        if not is_scan(raw):
            raise ValueError("Say by order which duplicate comes first: these rows don't come from files")
        raw = raw.select("*", place_in_files().alias("_loaded"))
    else:
        raw = raw.withColumn("_loaded", F.struct(*order))
    picked = extract_columns(raw, CUSTOMER_ID, [*features, "_loaded"], target, ["TotalCharges"])
    kept = keep_plausible(picked, CUSTOMER_ID, TENURE, *TENURE_RANGE, [F.col("_loaded")])
    return kept.drop("_loaded")


def clean_official(sheet: DataFrame, sequence: Column, first_day: str = FIRST_OFFICIAL_DAY, day_first: bool = False) -> DataFrame:
    """One row per published day: dates in any common form from ``first_day`` on, numeric prices, last entry wins.

    Lines whose date does not parse (units, footers) drop out; :func:`official_rejects` lists them. ``sequence`` is
    the publication order that decides between entries of one day.
    """
    # As a row of its own the date is read once; the filter would repeat a mere expression.
    dated = sheet.select(
        F.inline(F.array(read_date(F.col("date"), day_first))),
        *[to_number(F.col(c)).alias(c) for c in OFFICIAL_PRICES],
        sequence.alias("_sequence"),
    ).drop("status").filter(F.col("date") >= F.lit(first_day).cast("date"))
    return first_per_key(dated, ["date"], [F.col("_sequence").desc()]).drop("_sequence")


def official_rejects(sheet: DataFrame, day_first: bool = False) -> DataFrame:
    """Every date cell that :func:`clean_official` could not read, with the reason and the number of its lines."""
    return date_rejects(sheet, "date", day_first)
