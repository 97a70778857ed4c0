"""The reading log: raw readings to a reviewed dataset and its exports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.clean import clean_official
from tabulon.operators.features import public_export
from tabulon.operators.flags import flag_board, flag_readings
from tabulon.operators.lookup import locate
from tabulon.operators.ordering import chronological
from tabulon.operators.overrides import (
    apply_board_overrides, apply_reading_overrides, latest_overrides, upsert_overrides,
)
from tabulon.schemas import BOARD_OVERRIDES, GEO_FIELDS, OFFICIAL, READING_OVERRIDES
from tabulon.session import scratch_path
from tabulon.sources.corrections import corrections_as_of
from tabulon.sources.incremental import reuse_and_new, unprocessed
from tabulon.sources.metadata import flatten_reading, metadata_fields
from tabulon.sources.readers import read_or_empty, read_published_sheet
from tabulon.sources.workbook import read_published_workbook
from tabulon.sources.writers import write_csv, write_json, write_layer

#: Headers of the published sheet and the columns they become.
SHEET_COLUMNS = {
    "FECHA": "date",
    "Tipo de Cambio": "exchange_rate_usd_gtq",
    "Gasolina Superior": "official_super_gtq",
    "Gasolina Regular": "official_regular_gtq",
    "Aceite Combustible Diésel": "official_diesel_gtq",
}


@dataclass(frozen=True)
class ReadingLogPaths:
    """Where one log keeps its inputs and outputs."""

    reading_overrides: str
    board_overrides: str
    official: str
    dataset: str
    json_export: str
    public_export: str


def _last_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The row entered last of each key, in the order of files and of rows in a file.

    Files count in the order of their names; where corrections are appended in several writes, keep them as a log
    (``tabulon.sources.corrections``), whose numbers don't depend on names.
    """
    entered = F.struct(F.input_file_name(), F.monotonically_increasing_id())
    return latest_overrides(rows.withColumn("_entered", entered), key, ["_entered"])


def log_rows(
    dumps: DataFrame,
    recognised: DataFrame,
    places: DataFrame,
    previous: DataFrame | None = None,
    force: bool = False,
    place_fields: Sequence[str] = GEO_FIELDS,
) -> DataFrame:
    """One raw row per photo of ``dumps`` (``filename``, ``metadata`` as JSON).

    Photos that ``previous`` holds are taken over from it, the others are built from
    their metadata, their reading in ``recognised`` (``filename``, ``pump``, ``board``;
    no reading gives empty fields) and their place. Under ``force`` all are built.
    Photos no longer in ``dumps`` leave the log.
    """
    todo = dumps if previous is None else unprocessed(dumps, previous, "filename", force)
    read = metadata_fields(todo, "metadata").drop("metadata").join(recognised, "filename", "left")
    fresh = locate(flatten_reading(read), places, fields=place_fields)
    return fresh if previous is None or force else reuse_and_new(previous, fresh, dumps, "filename")


def derive_log(
    readings: DataFrame,
    reading_overrides: DataFrame,
    board_overrides: DataFrame,
    official: DataFrame,
    notes_are_array: bool = True,
    staging: str | None = None,
) -> DataFrame:
    """Baseline, corrections, board, review flags; depends on raw columns only.

    Of repeated corrections of a key, and of repeated official days, the last counts.

    Flagging reads the merged rows three times (bracket, median, flags). With
    ``staging`` they are stored there first, so the joins run once.
    """
    corrected = apply_reading_overrides(readings, _last_per_key(reading_overrides, "filename"))
    boarded = apply_board_overrides(
        corrected, _last_per_key(official, "date"), _last_per_key(board_overrides, "filename")
    )
    if staging:
        boarded = write_layer(boarded, staging)
    return flag_board(flag_readings(boarded, notes_are_array))


def refresh(
    spark: SparkSession, readings: DataFrame, paths: ReadingLogPaths, notes_are_array: bool = True,
    from_logs: bool = False, as_of: int | None = None, board_as_of: int | None = None,
) -> DataFrame:
    """Derive the log and write dataset, JSON and public export.

    The dataset is stored once; both exports restart from the stored table, so a
    lost executor never makes them recompute the derivation. Point ``dataset`` at a
    new path per run: the readings may come from the previous version.

    ``from_logs``: both override paths are append-only logs (``tabulon.sources.corrections``), read as of the given
    sequence numbers (None: all).
    """
    if from_logs:
        corrections = corrections_as_of(spark, paths.reading_overrides, READING_OVERRIDES, "filename", as_of)
        board = corrections_as_of(spark, paths.board_overrides, BOARD_OVERRIDES, "filename", board_as_of)
    else:
        corrections = read_or_empty(spark, paths.reading_overrides, READING_OVERRIDES, multi_line=True)
        board = read_or_empty(spark, paths.board_overrides, BOARD_OVERRIDES, multi_line=True)
    derived = derive_log(
        readings, corrections, board,
        read_or_empty(spark, paths.official, OFFICIAL),
        notes_are_array,
        scratch_path(spark, "merged"),
    )
    stored = write_layer(chronological(derived, "datetime_original", "filename"), paths.dataset)
    write_json(stored, paths.json_export)
    write_csv(
        public_export(stored, read_or_empty(spark, paths.official, OFFICIAL)), paths.public_export
    )
    return stored


def publish_official(spark: SparkSession, sheet: str, target: str, sheet_name: str | None = None) -> DataFrame:
    """Clean a published price sheet into the reference table; later lines of a day win.

    ``sheet`` is a workbook (``.xlsx``), a folder of workbooks if ``sheet_name`` is given, or else a CSV export.
    Workbooks of a folder count in the order of their names.
    """
    if sheet_name or sheet.endswith(".xlsx"):
        cells = read_published_workbook(spark, sheet, SHEET_COLUMNS, sheet_name)
        line = F.struct("file", "sheet_row")
    else:
        cells = read_published_sheet(spark, sheet, SHEET_COLUMNS)
        line = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    write_csv(clean_official(cells, line), target)
    return read_or_empty(spark, target, OFFICIAL)


def save_override(spark: SparkSession, new_rows: DataFrame, current: str, target: str, board: bool = False) -> DataFrame:
    """Upsert corrections and write the whole table to a new path.

    Writing beside the old version keeps it readable until the new one is complete.
    """
    schema = BOARD_OVERRIDES if board else READING_OVERRIDES
    merged = upsert_overrides(read_or_empty(spark, current, schema, multi_line=True), new_rows.select(*schema.names), "filename")
    write_csv(merged, target)
    return read_or_empty(spark, target, schema, multi_line=True)
