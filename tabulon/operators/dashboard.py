"""The numbers behind a report page: headline figures, series, tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.dates import exif_timestamp, show_timestamp
from tabulon.functions.text import badge, money, number_or_dash, pending_label
from tabulon.operators.ordering import ROWS_PER_CELL, with_position
from tabulon.operators.overrides import SOURCE_HUMAN, SOURCE_READER
from tabulon.schemas import BOARD_PRICES

#: Display texts, axis padding.
BADGES = {SOURCE_READER: "Auto (OCR)", SOURCE_HUMAN: "Reviewed"}
BADGE_OTHER = "Failed"
AXIS_PAD_SHARE, AXIS_PAD_MIN = 0.25, 1.0
PENDING_READING, PENDING_BOARD = "carga", "tablero"
PENDING_LEAD = " · ⚠️ falta "
TITLE_GAP = " — "


def trend(delta: Column) -> Column:
    """An unknown change shows as flat."""
    return F.when(delta > 0, "up").when(delta < 0, "down").otherwise("flat")


def headline(df: DataFrame, entity: Sequence[str] = (), when: Column | None = None) -> DataFrame:
    """First and latest valid price, their change, mean price, and row counts by source.

    First and latest come from ``min_by``/``max_by``: no sort, and partial results
    merge per task. Ties on the moment fall to the key.
    """
    moment = exif_timestamp(F.col("datetime_original")) if when is None else when
    valid = F.col("parse_ok")
    at = F.when(valid & moment.isNotNull(), F.struct(moment, F.col("filename")))
    price = F.col("price_per_gallon_gtq")
    row = F.struct(price.alias("price"), moment.alias("at"), F.col("gallons").alias("gallons"))
    grouped = df.groupBy(*entity).agg(
        F.min_by(row, at).alias("_first"),
        F.max_by(row, at).alias("_last"),
        F.avg(F.when(valid, price)).alias("mean_price"),
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("data_source") == SOURCE_READER).alias("n_auto"),
        F.count_if(F.col("data_source") == SOURCE_HUMAN).alias("n_reviewed"),
    )
    delta = F.col("_last.price") - F.col("_first.price")
    return grouped.select(
        *entity,
        F.col("_first.price").alias("first_price"), F.col("_last.price").alias("latest_price"),
        F.col("_first.at").alias("first_at"), F.col("_last.at").alias("latest_at"),
        F.col("_last.gallons").alias("latest_gallons"),
        delta.alias("delta"),
        (F.try_divide(delta, F.col("_first.price")) * 100).alias("delta_pct"),
        trend(delta).alias("trend"),
        "mean_price", "n_total", "n_auto", "n_reviewed",
    )


def pending_counts(df: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Sizes of the two review queues."""
    return df.groupBy(*entity).agg(
        F.count_if(F.col("needs_review") & (F.col("data_source") != SOURCE_HUMAN)).alias("n_pending"),
        F.count_if("board_needs_review").alias("n_board_pending"),
    )


def latest_confirmed_board(df: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """The most recent row with all four board prices known."""
    at = F.struct(exif_timestamp(F.col("datetime_original")), F.col("filename"))
    latest = F.max_by(F.struct("filename", "datetime_original", *BOARD_PRICES), at)
    return df.na.drop(subset=BOARD_PRICES).groupBy(*entity).agg(latest.alias("r")).select(*entity, "r.*")


def chart_series(
    df: DataFrame, entity: Sequence[str] = (), order: Sequence[str] = ("datetime_original", "filename"),
    value: str = "price_per_gallon_gtq", rows_per_cell: int = ROWS_PER_CELL, extent: DataFrame | None = None,
    valid: Column | None = None,
) -> DataFrame:
    """Each valid row's place in its chart: position, axis domain and coordinates in [0, 1].

    Rows count where ``valid`` holds, else where the reading parsed. The axis is
    padded by a quarter of the range, at least 1. A series of fewer than two points
    has no chart and yields no rows.
    """
    rows = df.filter(F.col("parse_ok") if valid is None else valid)
    placed = with_position(
        rows, order, entity, rows_per_cell, {"min_value": F.min(value), "max_value": F.max(value)}, extent,
    ).filter(F.col("series_rows") >= 2)
    pad = F.greatest((F.col("max_value") - F.col("min_value")) * AXIS_PAD_SHARE, F.lit(AXIS_PAD_MIN))
    low, high = F.col("min_value") - pad, F.col("max_value") + pad
    return placed.withColumns({"axis_low": low, "axis_high": high}).withColumns({
        "x": F.col("position") / (F.col("series_rows") - 1),
        "y": 1 - (F.col(value) - F.col("axis_low")) / (F.col("axis_high") - F.col("axis_low")),
    })


def board_series(df: DataFrame, entity: Sequence[str] = (), rows_per_cell: int = ROWS_PER_CELL,
                 extent: DataFrame | None = None) -> DataFrame:
    """One chart series per board fuel, over the rows where that fuel's price is known.

    Rows become (``fuel``, ``price``) once; a series is an entity's fuel.
    """
    long = df.unpivot([*entity, "filename", "datetime_original"], BOARD_PRICES, "fuel", "price")
    return chart_series(long, [*entity, "fuel"], value="price", rows_per_cell=rows_per_cell, extent=extent,
                        valid=F.col("price").isNotNull())


def display_rows(df: DataFrame) -> DataFrame:
    """Table cells as text: moment, total, gallons, price, badge, label."""
    moment = exif_timestamp(F.col("datetime_original"))
    pending = [
        (F.col("needs_review") & (F.col("data_source") != SOURCE_HUMAN), PENDING_READING),
        (F.col("board_needs_review"), PENDING_BOARD),
    ]
    title = F.concat(show_timestamp(moment), F.lit(TITLE_GAP), F.col("filename"))
    return df.select(
        "filename",
        show_timestamp(moment).alias("shown_at"),
        F.coalesce(money(F.col("total_gtq")), F.lit("—")).alias("total"),
        number_or_dash(F.col("gallons"), 3).alias("gallons"),
        F.concat(F.lit("Q"), number_or_dash(F.col("price_per_gallon_gtq"), 4)).alias("price"),
        badge(F.col("data_source"), BADGES, BADGE_OTHER).alias("badge"),
        pending_label(title, pending, PENDING_LEAD).alias("label"),
        F.coalesce("override_note", F.lit("")).alias("note"),
    )
