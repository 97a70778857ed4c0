"""Reading-log tables made from the event table, in Spark and in SQL.

Every event is one reading: its value gives the digits a display would show, its
type decides what went wrong, and its property number spreads the board prices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.catalog.registry import table
from tabulon.operators.clean import clean_official
from tabulon.operators.overrides import latest_overrides
from tabulon.plans.reading_log import SHEET_COLUMNS
from tabulon.session import scratch_path
from tabulon.sources.workbook_writer import write_workbooks

NOTE = "total_assumed_default_not_confirmed_by_ocr"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint").cast("string")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    e = events(spark, folder)
    kind, k = F.col("event_type"), F.col("k")
    board = F.round(F.try_divide(F.lit(1500.0), "value") + (k - 50) / 10.0, 2)
    board_digits = F.round(board * 100).cast("bigint").cast("string")
    return e.select(
        F.concat(F.lit("R"), F.lpad(F.col("event_id").cast("string"), 10, "0")).alias("filename"),
        "user_id",
        F.date_format("ts", "yyyy:MM:dd HH:mm:ss").alias("datetime_original"),
        F.when(kind == "error", "15").when(kind == "signup", cents("value"))
        .when(kind != "view", "15000").alias("total_raw"),
        cents("value").alias("gallons_raw"),
        F.when(kind == "view", F.array(F.lit("lcd_found"), F.lit(NOTE)))
        .when(k < 50, F.array(F.lit("gallons_not_found")))
        .otherwise(F.array().cast("array<string>")).alias("notes"),
        F.when(kind != "click", board_digits).alias("price_diesel_raw"),
        F.when(k >= 20, board_digits).alias("price_regular_raw"),
        F.lit(None).cast("string").alias("price_super_raw"),
        board_digits.alias("price_vpower_raw"),
    )


def override_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two corrections per failed reading; the second one counts, even where it has no gallons."""
    e = events(spark, folder).filter("event_type = 'error'")
    name = F.concat(F.lit("R"), F.lpad(F.col("event_id").cast("string"), 10, "0"))
    first = e.select(
        name.alias("filename"), F.lit(150.0).alias("total_gtq"), F.lit(1.5).alias("gallons"),
        F.lit("first look").alias("override_note"), F.lit(1).alias("seq"),
    )
    second = e.select(
        name, F.lit(150.0), F.nullif(F.col("k"), F.lit(0)) / 10.0, F.concat(F.lit("k="), F.col("k").cast("string")),
        F.lit(2),
    )
    return first.union(second)


def overrides(spark: SparkSession, folder: str) -> DataFrame:
    return latest_overrides(override_log(spark, folder), "filename", ["seq"])


def board_overrides(spark: SparkSession, folder: str) -> DataFrame:
    e = events(spark, folder).filter("event_type = 'signup' AND k < 30")
    k = F.col("k").cast("double")
    return e.select(
        F.concat(F.lit("R"), F.lpad(F.col("event_id").cast("string"), 10, "0")).alias("filename"),
        (k + 30.5).alias("price_diesel_gtq"), (k + 31.5).alias("price_regular_gtq"),
        (k + 32.5).alias("price_super_gtq"), F.nullif(k + 33.5, F.lit(33.5)).alias("price_vpower_gtq"),
        F.lit("seen").alias("note"),
    )


#: A publication writes its days in any way that people do; ISO days are true date cells in a workbook.
DAY_FORMS = (
    "MM/dd/yyyy", "yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss'Z'", "d MMMM yyyy", "MMM d yyyy", "yyyyMMdd",
    "MM.dd.yyyy", "M/d/yy", "EEEE, MMMM d, yyyy",
)
NO_DAYS = ("Unidades:", "2021-02-30", None, "Hoja 7 de 12")
SHEET = "PUBLICATION"


def in_turn(number: Column, values: list[Column]) -> Column:
    """The value whose turn it is by the number; only that one is computed."""
    turn = F.pmod(number, F.lit(len(values)))
    return reduce(lambda c, n: c.when(turn == n, values[n]), range(1, len(values)), F.when(turn == 0, values[0]))


def published(spark: SparkSession, folder: str) -> DataFrame:
    """A price sheet with unit lines and impossible days, many date styles, text prices and repeated days."""
    e = events(spark, folder)
    kind, k = F.col("event_type"), F.col("k")
    written = in_turn(k, [F.date_format("ts", f) for f in DAY_FORMS])
    no_day = in_turn(k, [F.lit(t) for t in NO_DAYS])
    return e.select(
        F.when((kind == "error") | (F.dayofmonth("ts") >= 28), no_day).when(kind == "signup", written)
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date"),
        F.concat(F.lit(" 7."), k.cast("string")).alias("exchange_rate_usd_gtq"),
        (k + 20).cast("string").alias("official_super_gtq"),
        F.when(k > 60, "n/d").otherwise((k + 18).cast("string")).alias("official_regular_gtq"),
        (k + 16).cast("string").alias("official_diesel_gtq"),
        "event_id",
    )


def official(spark: SparkSession, folder: str) -> DataFrame:
    return clean_official(published(spark, folder), F.col("event_id"))


def workbooks(spark: SparkSession, folder: str) -> str:
    """The sheet as a folder of workbooks: header on row 7 with blanks, columns nobody asked for, unit line, footers."""
    target = scratch_path(spark, "workbooks")
    lines = published(spark, folder)
    iso = F.rlike("date", F.lit(r"^\d{4}-\d\d-\d\d$"))
    day = F.when(iso, F.col("date").try_cast("date"))
    lines = lines.withColumns({"_cell": day, "_text": F.col("date"), "_nothing": F.lit(None).cast("string")})
    names = list(SHEET_COLUMNS)
    above = [["Publication"], [], ["prices"], [], [], [], [f" {names[0]} ", "Extra", "Old day", *names[1:]], ["Unidades:", None, None, "GTQ/USD"]]
    columns = [("_cell", "_text"), "event_id", "_nothing", *[SHEET_COLUMNS[n] for n in names[1:]]]
    write_workbooks(lines, target, "event_id", columns, above, [["Fuente: the ministry"], [None, "end"]], SHEET)
    return target


# --- the same tables in SQL -------------------------------------------------

EVENTS_SQL = """
ev AS (SELECT event_id, ts, user_id, event_type, value, props,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              'R' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS filename FROM events)"""

READINGS_SQL = EVENTS_SQL + f""",
readings AS (
  SELECT filename, user_id, strftime(ts, '%Y:%m:%d %H:%M:%S') AS datetime_original, CAST(ts AS DATE) AS day,
    CASE event_type WHEN 'error' THEN '15'
         WHEN 'signup' THEN CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
         WHEN 'view' THEN NULL ELSE '15000' END AS total_raw,
    CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS gallons_raw,
    CASE WHEN event_type = 'view' THEN ['lcd_found', '{NOTE}']
         WHEN k < 50 THEN ['gallons_not_found'] ELSE [] END AS notes,
    CAST(CAST(round(round(1500.0 / nullif(value, 0) + (k - 50) / 10.0, 2) * 100) AS BIGINT) AS VARCHAR) AS digits,
    event_type, k
  FROM ev),
overrides AS (
  SELECT filename, 150.0::DOUBLE AS total_gtq, nullif(k, 0) / 10.0 AS gallons, 'k=' || CAST(k AS VARCHAR) AS override_note
  FROM ev WHERE event_type = 'error'),
base AS (
  SELECT *, CASE WHEN length(total_raw) >= 3 THEN CAST(total_raw AS DOUBLE) / 100 END AS total0,
            CASE WHEN length(gallons_raw) = 4 THEN CAST(gallons_raw AS DOUBLE) / 1000 END AS gallons0
  FROM readings),
merged AS (
  SELECT b.filename, b.user_id, b.datetime_original, b.day, b.notes, b.digits, b.event_type, b.k,
    CASE WHEN o.filename IS NOT NULL THEN o.total_gtq ELSE total0 END AS total_gtq,
    CASE WHEN o.filename IS NOT NULL THEN o.gallons ELSE gallons0 END AS gallons,
    CASE WHEN o.filename IS NOT NULL THEN round(o.total_gtq / nullif(o.gallons, 0), 4)
         ELSE round(nullif(total0, 0) / nullif(gallons0, 0), 4) END AS price_per_gallon_gtq,
    o.filename IS NOT NULL OR (total0 IS NOT NULL AND coalesce(gallons0, 0) <> 0) AS parse_ok,
    CASE WHEN o.filename IS NOT NULL THEN 'manual_override' ELSE 'ocr' END AS data_source,
    CASE WHEN o.filename IS NOT NULL THEN o.override_note ELSE '' END AS override_note
  FROM base b LEFT JOIN overrides o ON b.filename = o.filename)"""

OFFICIAL_SQL = """
sheet AS (
  SELECT CASE WHEN event_type <> 'error' AND day(ts) < 28 THEN CAST(ts AS DATE) END AS date,
    ' 7.' || CAST(k AS VARCHAR) AS rate, CAST(k + 20 AS VARCHAR) AS s,
    CASE WHEN k > 60 THEN 'n/d' ELSE CAST(k + 18 AS VARCHAR) END AS r, CAST(k + 16 AS VARCHAR) AS g, event_id
  FROM ev),
dated AS (
  SELECT date,
    TRY_CAST(trim(rate) AS DOUBLE) AS exchange_rate_usd_gtq, TRY_CAST(s AS DOUBLE) AS official_super_gtq,
    TRY_CAST(r AS DOUBLE) AS official_regular_gtq, TRY_CAST(g AS DOUBLE) AS official_diesel_gtq, event_id
  FROM sheet),
official AS (
  SELECT date, exchange_rate_usd_gtq, official_super_gtq, official_regular_gtq, official_diesel_gtq FROM (
    SELECT *, row_number() OVER (PARTITION BY date ORDER BY event_id DESC) AS rn FROM dated
    WHERE date >= DATE '2021-01-01') WHERE rn = 1)"""

FLAGS_SQL = """
valid AS (SELECT count(*) AS n, median(price_per_gallon_gtq) AS med FROM merged WHERE parse_ok),
flagged AS (
  SELECT m.*, concat_ws(';',
    CASE WHEN NOT parse_ok THEN 'ocr_parse_failed' END,
    CASE WHEN abs(total_gtq - 150.0) > 0.01 THEN 'total_not_150gtq' END,
    CASE WHEN list_contains(notes, '""" + NOTE + """') AND data_source <> 'manual_override'
         THEN 'total_assumed_not_confirmed_by_ocr' END,
    CASE WHEN parse_ok AND n >= 3 AND abs(price_per_gallon_gtq - med) / nullif(med, 0) > 0.15
         THEN 'price_deviates_from_median' END) AS review_reason
  FROM merged m, valid)"""

BOARD_SQL = """
board0 AS (
  SELECT f.*, o.date IS NOT NULL AS published, o.official_regular_gtq AS ro, o.official_diesel_gtq AS dio,
    CASE WHEN length(regexp_replace(digits, '[^0-9]', '', 'g')) = 4
         THEN CAST(regexp_replace(digits, '[^0-9]', '', 'g') AS DOUBLE) / 100 END AS own
  FROM flagged f LEFT JOIN official o ON f.day = o.date),
board1 AS (
  SELECT *, coalesce(event_type <> 'click' AND abs(own - price_per_gallon_gtq) <= 3.0, FALSE) AS d_ok,
    coalesce(k >= 20 AND abs(own - price_per_gallon_gtq) <= 3.0, FALSE) AS r_ok,
    coalesce(abs(own - price_per_gallon_gtq) <= 3.0, FALSE) AS v_ok FROM board0),
board2 AS (
  SELECT *, CASE WHEN d_ok THEN own WHEN published THEN dio END AS pd,
    CASE WHEN r_ok THEN own WHEN published THEN ro END AS pr, CASE WHEN v_ok THEN own END AS pv,
    event_type = 'signup' AND k < 30 AS human,
    CASE WHEN published AND NOT (d_ok AND r_ok) THEN 'auto+official_mem'
         WHEN price_per_gallon_gtq IS NOT NULL THEN 'auto' ELSE 'unconfirmed' END AS origin
  FROM board1),
boarded AS (
  SELECT * EXCLUDE (origin),
    CASE WHEN human THEN k + 30.5::DOUBLE ELSE pd END AS price_diesel_gtq,
    CASE WHEN human THEN k + 31.5::DOUBLE ELSE pr END AS price_regular_gtq,
    CASE WHEN human THEN k + 32.5::DOUBLE ELSE price_per_gallon_gtq END AS price_super_gtq,
    CASE WHEN human THEN nullif(k + 33.5::DOUBLE, 33.5) ELSE pv END AS price_vpower_gtq,
    CASE WHEN human THEN 'manual' ELSE origin END AS board_data_source,
    CASE WHEN human THEN 'seen' ELSE '' END AS board_override_note
  FROM board2),
log AS (
  SELECT *, review_reason <> '' AS needs_review,
    (price_diesel_gtq IS NULL OR price_regular_gtq IS NULL OR price_super_gtq IS NULL OR price_vpower_gtq IS NULL)
      AS board_needs_review FROM boarded)"""

LOG_SQL = "WITH " + ",".join([READINGS_SQL, OFFICIAL_SQL, FLAGS_SQL, BOARD_SQL])
