"""Review flags with readable reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.numbers import relative_deviation, within
from tabulon.functions.text import has_note, join_reasons
from tabulon.operators.overrides import SOURCE_HUMAN
from tabulon.operators.quantiles import exact_medians
from tabulon.operators.select import any_missing
from tabulon.schemas import BOARD_PRICES

#: The usual total, tolerances, gate, and reason texts.
EXPECTED_TOTAL = 150.00
TOTAL_TOLERANCE = 0.01
MIN_VALID_ROWS = 3
MAX_DEVIATION = 0.15
ASSUMED_TOTAL_NOTE = "total_assumed_default_not_confirmed_by_ocr"
REASON_UNREAD = "ocr_parse_failed"
REASON_TOTAL = "total_not_150gtq"
REASON_ASSUMED = "total_assumed_not_confirmed_by_ocr"
REASON_PRICE = "price_deviates_from_median"
REASON_BOARD = "board_prices_unconfirmed"


def flag_readings(df: DataFrame, notes_are_array: bool = True) -> DataFrame:
    """Add ``needs_review`` and ``review_reason``.

    The price rule needs at least three valid rows; its centre is the exact median
    of their prices. It arrives as a scalar subquery, so no row passes the driver,
    and is null (no price is flagged) while there are too few.
    """
    price = F.col("price_per_gallon_gtq")
    valid = df.select(F.when(F.col("parse_ok"), price).alias("price"), "parse_ok")
    gate = F.count_if("parse_ok") >= MIN_VALID_ROWS
    median = exact_medians(valid, ["price"], gate).select("median").scalar()
    reasons = join_reasons([
        (~F.col("parse_ok"), REASON_UNREAD),
        (~within(F.col("total_gtq"), F.lit(EXPECTED_TOTAL), TOTAL_TOLERANCE), REASON_TOTAL),
        (
            has_note(F.col("notes"), ASSUMED_TOTAL_NOTE, notes_are_array)
            & (F.col("data_source") != SOURCE_HUMAN),
            REASON_ASSUMED,
        ),
        (F.col("parse_ok") & (relative_deviation(price, median) > MAX_DEVIATION), REASON_PRICE),
    ])
    return df.withColumn("review_reason", reasons).withColumn("needs_review", F.col("review_reason") != "")


def flag_board(df: DataFrame) -> DataFrame:
    """Add ``board_needs_review`` and its reason: any of the four prices missing."""
    missing = any_missing(BOARD_PRICES)
    return df.withColumns({
        "board_needs_review": missing,
        "board_review_reason": F.when(missing, F.lit(REASON_BOARD)).otherwise(F.lit("")),
    })


def review_queue(df: DataFrame) -> DataFrame:
    """Rows a human still has to look at."""
    return df.filter(F.col("needs_review") & (F.col("data_source") != SOURCE_HUMAN))
