"""Reading-log queries: digits, overrides, backfill, flags, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog import standins as S
from tabulon.catalog.registry import query, table
from tabulon.functions import (
    clean_digits, day_of, digits_only, gallons_from_digits, map_labels, pick_corroborated, price_from_digits, read_date,
    total_from_digits,
)
from tabulon.operators.clean import clean_official, official_rejects
from tabulon.operators.corroborate import corroborated_rows
from tabulon.operators.features import lag_features, public_export
from tabulon.operators.flags import flag_board, flag_readings
from tabulon.operators.lookup import locate, official_on_day, place_city, unknown_places
from tabulon.operators.ordering import first_per_key
from tabulon.operators.overrides import (
    apply_board_overrides, apply_reading_overrides, board_baseline, split_valid, upsert_overrides,
)
from tabulon.operators.select import stack
from tabulon.plans.reading_log import SHEET_COLUMNS, derive_log, log_rows, save_override
from tabulon.schemas import BOARD_PRICES
from tabulon.session import scratch_path
from tabulon.sources.corrections import append_corrections, corrections_as_of
from tabulon.sources.file_order import place_in_files, with_load_order
from tabulon.sources.metadata import metadata_fields
from tabulon.sources.workbook import read_published_workbook
from tabulon.sources.writers import write_csv, write_layer


@query("WITH " + S.READINGS_SQL + "," + S.FLAGS_SQL + """
SELECT filename, total_gtq, price_per_gallon_gtq, parse_ok, data_source, review_reason,
       review_reason <> '' AS needs_review FROM flagged""")
def flag_outliers(spark, folder):
    """Corrections are merged once and stored; the median and the flags restart from there."""
    corrected = apply_reading_overrides(S.readings(spark, folder), S.overrides(spark, folder)).select(
        "filename", "total_gtq", "price_per_gallon_gtq", "parse_ok", "data_source", "notes"
    )
    stored = write_layer(corrected, scratch_path(spark, "merged"))
    return flag_readings(stored).select(
        "filename", "total_gtq", "price_per_gallon_gtq", "parse_ok", "data_source", "review_reason", "needs_review"
    )


_AS_OF_SQL = "WITH " + S.EVENTS_SQL + """,
first AS (SELECT filename, 150.0::DOUBLE AS total_gtq, 1.5::DOUBLE AS gallons, 'first look' AS override_note FROM ev WHERE event_type = 'error'),
second AS (SELECT filename, 150.0::DOUBLE AS total_gtq, nullif(k, 0) / 10.0 AS gallons, 'k=' || CAST(k AS VARCHAR) AS override_note
           FROM ev WHERE event_type = 'error'),
half AS (SELECT *, row_number() OVER (ORDER BY filename) AS n, count(*) OVER () AS rows FROM second)
SELECT 'first append' AS known, * FROM first
UNION ALL SELECT 'half of the second', f.filename, f.total_gtq, CASE WHEN n <= rows // 2 THEN h.gallons ELSE f.gallons END,
  CASE WHEN n <= rows // 2 THEN h.override_note ELSE f.override_note END FROM first AS f JOIN half AS h USING (filename)
UNION ALL SELECT 'all', * FROM second"""


@query(_AS_OF_SQL)
def corrections_as_known(spark, folder):
    """Two appends of corrections, read as of the first one, as of a number amid the second one, and as of now."""
    log, rows = scratch_path(spark, "corrections"), S.override_log(spark, folder)
    first = append_corrections(rows.filter("seq = 1"), log, ["filename"])
    last = append_corrections(rows.filter("seq = 2"), log, ["filename"])
    points = {"first append": first, "half of the second": first + (last - first) // 2, "all": None}
    schema = rows.drop("seq").schema
    return stack(*[corrections_as_of(spark, log, schema, "filename", n).withColumn("known", F.lit(name)) for name, n in points.items()])


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS load_order FROM events")
def ingestion_order(spark, folder):
    """Events delivered as a small folder of files and a large one, numbered in the order of delivery after they were read."""
    delivered = _delivery(spark, folder)
    return with_load_order(spark.read.parquet(f"{delivered}/*")).select("event_id", "load_order").repartition(7)


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def first_delivered(spark, folder):
    """Each user's first row in the order of delivery."""
    scan = spark.read.parquet(f"{_delivery(spark, folder)}/*").select("user_id", "event_id", place_in_files().alias("place"))
    return first_per_key(scan.repartition(5), ["user_id"], [F.col("place")]).select("user_id", "event_id")


def _delivery(spark, folder):
    out, events = scratch_path(spark, "delivery"), table(spark, folder, "events")
    edge = events.agg(F.percentile_approx("event_id", 0.05)).first()[0]
    for name, part, files in (("a", F.col("event_id") <= edge, 1), ("b", F.col("event_id") > edge, 4)):
        events.filter(part).repartitionByRange(files, "event_id").sortWithinPartitions("event_id").write.parquet(f"{out}/{name}")
    return out


_BOARD_ORDERS = """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') IS NULL OR o_orderstatus = 'P' AS board_needs_review,
  CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'board_prices_unconfirmed' ELSE '' END
    AS board_review_reason,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS closed
FROM orders"""


def _order_board(spark, folder):
    o = table(spark, folder, "orders")
    low, part = F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus") == "P"
    price = F.col("o_totalprice")
    return o.select(
        "o_orderkey", "o_orderstatus",
        F.when(~low, price).alias("price_diesel_gtq"), F.when(~part, price).alias("price_regular_gtq"),
        price.alias("price_super_gtq"), price.alias("price_vpower_gtq"),
    )


@query(_BOARD_ORDERS)
def board_flags(spark, folder):
    closed = map_labels(F.col("o_orderstatus"), {"F": 1, "O": 0})
    return flag_board(_order_board(spark, folder)).select(
        "o_orderkey", "board_needs_review", "board_review_reason", closed.alias("closed")
    )


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'")
def confirmed_rows(spark, folder):
    board = _order_board(spark, folder)
    return board.na.drop(subset=["price_diesel_gtq", "price_regular_gtq"]).select("o_orderkey")


@query("WITH " + S.EVENTS_SQL + "," + S.OFFICIAL_SQL + "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM official")
def official_daily(spark, folder):
    return S.official(spark, folder).withColumn("date", F.col("date").cast("string"))


@query("WITH " + S.EVENTS_SQL + "," + S.OFFICIAL_SQL + "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM official")
def official_workbook(spark, folder):
    """The sheet is written as workbooks and read back from them: header on row 7, unit lines, footers, later lines of a day win."""
    sheet = read_published_workbook(spark, S.workbooks(spark, folder), SHEET_COLUMNS, S.SHEET)
    daily = clean_official(sheet, F.struct("file", "sheet_row"))
    return daily.withColumn("date", F.col("date").cast("string"))


@query("WITH " + S.EVENTS_SQL + """
SELECT text, CASE text WHEN 'Unidades:' THEN 'no date' WHEN '2021-02-30' THEN 'no such day' WHEN 'Hoja 7 de 12' THEN 'unknown form'
                       ELSE 'missing' END AS reason, count(*) AS rows
FROM (SELECT CASE k % 4 WHEN 0 THEN 'Unidades:' WHEN 1 THEN '2021-02-30' WHEN 3 THEN 'Hoja 7 de 12' END AS text
      FROM ev WHERE event_type = 'error' OR day(ts) >= 28) GROUP BY text""")
def official_rejected(spark, folder):
    """Lines of the price sheet whose day could not be read, by text and reason."""
    return official_rejects(S.published(spark, folder))


_FORMS = [*S.DAY_FORMS, "yyyy-MM-dd", "yyyy/M/d H:mm", "d-MMM-yyyy h:mm a", "dd MMM yy", "yyyy MMM d"]


@query("WITH " + S.EVENTS_SQL + """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, 'parsed' AS status FROM ev""")
def mixed_dates(spark, folder):
    """Days of all events written in fifteen ways, and read again."""
    text = S.in_turn(F.col("event_id"), [F.date_format("ts", f) for f in _FORMS])
    found = table(spark, folder, "events").select("event_id", read_date(text).alias("d"))
    return found.select("event_id", F.col("d.date").cast("string").alias("day"), "d.status")


@query("WITH " + S.READINGS_SQL + "," + S.OFFICIAL_SQL + """
SELECT filename, exchange_rate_usd_gtq, official_super_gtq, official_regular_gtq, official_diesel_gtq,
  round(price_per_gallon_gtq - official_super_gtq, 6) AS markup
FROM merged LEFT JOIN official ON merged.day = official.date""")
def official_join(spark, folder):
    corrected = apply_reading_overrides(S.readings(spark, folder), S.overrides(spark, folder))
    joined = official_on_day(corrected, S.official(spark, folder), day_of(F.col("datetime_original")))
    markup = F.round(F.col("price_per_gallon_gtq") - F.col("official_super_gtq"), 6)
    return joined.select(
        "filename", "exchange_rate_usd_gtq", "official_super_gtq", "official_regular_gtq", "official_diesel_gtq",
        markup.alias("markup"),
    )


@query("WITH " + S.READINGS_SQL + """
SELECT filename, total_gtq, gallons, price_per_gallon_gtq, parse_ok, data_source, override_note FROM merged""")
def override_merge(spark, folder):
    return apply_reading_overrides(S.readings(spark, folder), S.overrides(spark, folder)).select(
        "filename", "total_gtq", "gallons", "price_per_gallon_gtq", "parse_ok", "data_source", "override_note"
    )


@query("WITH " + S.EVENTS_SQL + """,
log AS (SELECT filename, 150.0::DOUBLE AS total_gtq, 1.5::DOUBLE AS gallons, 'first look' AS override_note FROM ev
        WHERE event_type = 'error'),
fresh AS (SELECT filename, value AS total_gtq, k / 10.0 AS gallons, 'second look' AS override_note FROM ev
          WHERE event_type IN ('error', 'view') AND value > 40),
valid AS (SELECT * FROM fresh WHERE gallons > 0)
SELECT filename, total_gtq, gallons, override_note, TRUE AS accepted FROM log
WHERE filename NOT IN (SELECT filename FROM valid)
UNION ALL SELECT *, TRUE FROM valid
UNION ALL SELECT *, FALSE FROM fresh WHERE NOT gallons > 0""")
def override_upsert(spark, folder):
    existing = S.override_log(spark, folder).filter("seq = 1").drop("seq")
    e = S.events(spark, folder).filter("event_type IN ('error', 'view') AND value > 40")
    fresh = e.select(
        F.concat(F.lit("R"), F.lpad(F.col("event_id").cast("string"), 10, "0")).alias("filename"),
        F.col("value").alias("total_gtq"), (F.col("k") / 10.0).alias("gallons"), F.lit("second look").alias("override_note"),
    )
    accepted, rejected = split_valid(fresh, ["gallons"])
    kept = upsert_overrides(existing, accepted, "filename")
    return stack(kept.withColumn("accepted", F.lit(True)), rejected.withColumn("accepted", F.lit(False)))


@query(S.LOG_SQL + """
SELECT filename, price_diesel_gtq, price_regular_gtq, price_super_gtq, price_vpower_gtq, board_data_source,
       board_override_note FROM log""")
def board_backfill(spark, folder):
    corrected = apply_reading_overrides(S.readings(spark, folder), S.overrides(spark, folder))
    return apply_board_overrides(corrected, S.official(spark, folder), S.board_overrides(spark, folder)).select(
        "filename", "price_diesel_gtq", "price_regular_gtq", "price_super_gtq", "price_vpower_gtq",
        "board_data_source", "board_override_note",
    )


@query(S.LOG_SQL + """
SELECT origin AS board_data_source, count(*) AS n FROM board2 GROUP BY origin""")
def board_sources(spark, folder):
    corrected = apply_reading_overrides(S.readings(spark, folder), S.overrides(spark, folder))
    return board_baseline(corrected, S.official(spark, folder)).groupBy("board_data_source").agg(
        F.count(F.lit(1)).alias("n")
    )


_PLACE_TABLE_SQL = """
places AS (
  SELECT round(10 + n_nationkey * 0.5::DOUBLE, 4) AS lat4, round(-90 + n_nationkey * 0.25::DOUBLE, 4) AS lon4, n_name,
    coalesce(nullif(CASE WHEN n_regionkey = 0 THEN '' ELSE n_name END, ''),
             nullif(CASE WHEN n_regionkey = 0 THEN r_name END, ''), 'village') AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 2)"""

_PLACES_SQL = """
WITH spots AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE 10 + c_nationkey * 0.5::DOUBLE + c_acctbal / 1e9 END AS lat,
         -90 + c_nationkey * 0.25::DOUBLE AS lon FROM customer),
keyed AS (
  SELECT c_custkey, CASE WHEN lat <> 0 AND lon <> 0 THEN round(lat, 4) END AS lat4,
         CASE WHEN lat <> 0 AND lon <> 0 THEN round(lon, 4) END AS lon4 FROM spots),""" + _PLACE_TABLE_SQL


def _spots(spark, folder):
    c = table(spark, folder, "customer")
    lat = F.lit(10.0) + F.col("c_nationkey") * 0.5 + F.col("c_acctbal") / 1e9
    return c.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", 0.0).otherwise(lat).alias("gps_latitude"),
        (F.lit(-90.0) + F.col("c_nationkey") * 0.25).alias("gps_longitude"),
    )


def _places(spark, folder):
    n = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).filter("n_regionkey <> 2")
    first = F.col("n_regionkey") == 0
    return n.select(
        F.round(F.lit(10.0) + F.col("n_nationkey") * 0.5, 4).alias("lat4"),
        F.round(F.lit(-90.0) + F.col("n_nationkey") * 0.25, 4).alias("lon4"),
        F.col("n_name").alias("display_name"),
        place_city(F.when(first, "").otherwise(F.col("n_name")), F.when(first, F.col("r_name")), F.lit("village"))
        .alias("city"),
    )


@query(_PLACES_SQL + """
SELECT c_custkey, n_name AS geo_display_name, city AS geo_city
FROM keyed LEFT JOIN places ON keyed.lat4 = places.lat4 AND keyed.lon4 = places.lon4""")
def geo_lookup(spark, folder):
    return locate(_spots(spark, folder), _places(spark, folder), fields=["display_name", "city"]).select(
        "c_custkey", "geo_display_name", "geo_city"
    )


@query(_PLACES_SQL + """
SELECT DISTINCT lat4, lon4 FROM keyed WHERE lat4 IS NOT NULL AND lon4 IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM places WHERE places.lat4 = keyed.lat4 AND places.lon4 = keyed.lon4)""")
def geo_unknown(spark, folder):
    return unknown_places(_spots(spark, folder), _places(spark, folder))


def _photos(spark, folder):
    """(dumps, recognised, previous): a photo per event; those of small k are in the log already, some of them gone since."""
    e = S.events(spark, folder)
    name = F.concat(F.lit("R"), F.lpad(F.col("event_id").cast("string"), 10, "0")).alias("filename")
    spot = F.col("k") % 25
    tags = F.struct(
        F.date_format("ts", "yyyy:MM:dd HH:mm:ss").alias("DateTimeOriginal"), F.col("event_type").alias("Model"),
        F.when(F.col("event_type") == "click", 0.0).otherwise(F.lit(10.0) + spot * 0.5).alias("GPSLatitude"),
        (F.lit(-90.0) + spot * 0.25).alias("GPSLongitude"),
    )
    readings = S.readings(spark, folder)
    keys = {"diesel": "diesel", "regular": "regular", "super": "super", "v-power": "vpower"}
    prices = F.create_map(*[c for key, f in keys.items() for c in (F.lit(key), F.col(f"price_{f}_raw"))])
    crops = F.create_map(*[c for key in keys for c in (F.lit(key), F.concat("filename", F.lit(f"-{key}")))])
    recognised = readings.select(
        "filename", F.struct("total_raw", "gallons_raw", "notes").alias("pump"),
        F.struct(prices.alias("prices_raw"), crops.alias("crop_paths"), F.array(F.lit("board_found")).alias("notes"))
        .alias("board"),
    )
    done = readings.join(e.filter("k < 40").select(name, "k"), "filename").withColumns(
        {"camera_model": F.lit("stored"), "geo_city": F.lit("known"), "total_gtq": F.lit(-1.0)})
    gone = done.filter("k < 5").withColumn("filename", F.concat(F.lit("gone-"), "filename"))
    return e.select(name, F.to_json(tags).alias("metadata")), recognised, stack(done, gone).drop("k", "user_id")


@query(S.LOG_SQL + "," + _PLACE_TABLE_SQL + """
SELECT filename, datetime_original, CASE WHEN k < 40 THEN 'stored' ELSE event_type END AS camera_model,
  CASE WHEN k < 40 THEN 'known' ELSE city END AS geo_city, CASE WHEN k >= 40 THEN filename || '-diesel' END AS price_diesel_crop,
  CASE WHEN k >= 40 THEN 'board_found' END AS board_notes, total_gtq, price_per_gallon_gtq, data_source, review_reason,
  price_regular_gtq, price_vpower_gtq, board_data_source
FROM log LEFT JOIN places ON event_type <> 'click' AND lat4 = round(10 + (k % 25) * 0.5::DOUBLE, 4)
  AND lon4 = round(-90 + (k % 25) * 0.25::DOUBLE, 4)""")
def build_log(spark, folder):
    """Metadata, readings and places to the reviewed log; photos already in it are reused."""
    dumps, recognised, previous = _photos(spark, folder)
    rows = log_rows(dumps, recognised, _places(spark, folder), previous, place_fields=["display_name", "city"])
    log = derive_log(rows, S.overrides(spark, folder), S.board_overrides(spark, folder), S.official(spark, folder),
                     staging=scratch_path(spark, "merged"))
    return log.select(
        "filename", "datetime_original", "camera_model", "geo_city", "price_diesel_crop", "board_notes", "total_gtq",
        "price_per_gallon_gtq", "data_source", "review_reason", "price_regular_gtq", "price_vpower_gtq", "board_data_source",
    )


@query(S.LOG_SQL + """,
fresh AS (
  SELECT filename, value AS diesel, value + 1 AS regular, value + 2 AS super, k - 10.0::DOUBLE AS vpower FROM ev
  WHERE event_type IN ('signup', 'error') AND k < 15),
typed AS (SELECT * FROM fresh WHERE diesel > 0 AND regular > 0 AND super > 0 AND vpower > 0)
SELECT l.filename, CASE WHEN t.filename IS NULL THEN price_diesel_gtq ELSE diesel END AS price_diesel_gtq,
  CASE WHEN t.filename IS NULL THEN price_regular_gtq ELSE regular END AS price_regular_gtq,
  CASE WHEN t.filename IS NULL THEN price_super_gtq ELSE super END AS price_super_gtq,
  CASE WHEN t.filename IS NULL THEN price_vpower_gtq ELSE vpower END AS price_vpower_gtq,
  CASE WHEN t.filename IS NULL THEN board_data_source ELSE 'manual' END AS board_data_source,
  CASE WHEN t.filename IS NULL THEN board_override_note ELSE E'seen again,\nby hand' END AS board_override_note
FROM log l LEFT JOIN typed t ON l.filename = t.filename""")
def board_upsert(spark, folder):
    """New board readings replace older ones of their photo; the table is written, read back and applied to the log."""
    e = S.events(spark, folder).filter("event_type IN ('signup', 'error') AND k < 15")
    fresh = e.select(
        F.concat(F.lit("R"), F.lpad(F.col("event_id").cast("string"), 10, "0")).alias("filename"),
        F.col("value").alias("price_diesel_gtq"), (F.col("value") + 1).alias("price_regular_gtq"),
        (F.col("value") + 2).alias("price_super_gtq"), (F.col("k") - 10.0).alias("price_vpower_gtq"),
        F.lit("seen again,\nby hand").alias("note"),
    )
    out = scratch_path(spark, "board")
    write_csv(S.board_overrides(spark, folder), f"{out}/first")
    accepted, _ = split_valid(fresh, BOARD_PRICES)
    saved = save_override(spark, accepted, f"{out}/first", f"{out}/second", board=True)
    corrected = apply_reading_overrides(S.readings(spark, folder), S.overrides(spark, folder))
    return apply_board_overrides(corrected, S.official(spark, folder), saved).select(
        "filename", *BOARD_PRICES, "board_data_source", "board_override_note"
    )


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_value,
       CAST(NULL AS VARCHAR) AS absent FROM events""")
def json_fields(spark, folder):
    fields = [("k_value", ["other", "k"], "int"), ("absent", ["absent"], "string")]
    return metadata_fields(table(spark, folder, "events"), "props", fields).select("event_id", "k_value", "absent")


@query("""
WITH t AS (
  SELECT c_custkey AS id, c_name AS text FROM customer
  UNION ALL SELECT event_id, CAST(event_id AS VARCHAR) FROM events
  UNION ALL SELECT event_id, CAST(value AS VARCHAR) FROM events),
d AS (SELECT id, text, regexp_replace(text, '[^0-9]', '', 'g') AS digits,
  regexp_replace(regexp_replace(text, '^\\s*(-?\\d+)\\.0+\\s*$', '\\1'), '[^0-9]', '', 'g') AS cleaned FROM t)
SELECT id, digits, cleaned, CASE WHEN length(cleaned) >= 3 THEN CAST(cleaned AS DOUBLE) / 100 END AS total,
  CASE WHEN length(cleaned) = 4 THEN CAST(cleaned AS DOUBLE) / 1000 END AS gallons,
  CASE WHEN length(cleaned) = 4 THEN CAST(cleaned AS DOUBLE) / 100 END AS price FROM d""")
def digit_parse(spark, folder):
    e = table(spark, folder, "events")
    rows = stack(
        table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("text")),
        e.select(F.col("event_id").alias("id"), F.col("event_id").cast("string").alias("text")),
        e.select(F.col("event_id").alias("id"), F.col("value").cast("string").alias("text")),
    )
    cleaned = clean_digits(F.col("text"))
    return rows.select(
        "id", digits_only(F.col("text")).alias("digits"), cleaned.alias("cleaned"),
        total_from_digits(cleaned).alias("total"), gallons_from_digits(cleaned).alias("gallons"),
        price_from_digits(cleaned).alias("price"),
    )


@query("""
WITH c AS (SELECT user_id, event_id AS pos, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS text FROM events),
u AS (SELECT *, count(*) OVER (PARTITION BY user_id, left(text, 3)) - 1 AS support FROM c WHERE length(text) >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY support DESC, length(text) DESC, pos) AS rn FROM u),
users AS (SELECT DISTINCT user_id FROM events)
SELECT users.user_id, CASE WHEN support >= 1 THEN text END AS picked
FROM users LEFT JOIN r ON r.user_id = users.user_id AND rn = 1""")
def corroborate(spark, folder):
    rows = table(spark, folder, "events").select(
        "user_id", F.col("event_id").alias("pos"), S.cents("value").alias("text")
    )
    return corroborated_rows(rows, "user_id", "text", "pos")


@query("WITH " + S.EVENTS_SQL + """,
c AS (SELECT event_id, unnest([CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR),
         CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), CAST(k AS VARCHAR), CAST(k AS VARCHAR) || '7']) AS text,
         unnest([0, 1, 2, 3, 4]) AS pos FROM ev),
u AS (SELECT *, count(*) OVER (PARTITION BY event_id, left(text, 2)) - 1 AS support FROM c WHERE length(text) >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY support DESC, length(text) DESC, pos) AS rn FROM u)
SELECT e.event_id, CASE WHEN support >= 1 THEN text END AS picked
FROM ev e LEFT JOIN r ON r.event_id = e.event_id AND rn = 1""")
def corroborate_arrays(spark, folder):
    k = F.col("k").cast("string")
    candidates = F.array(
        F.col("event_id").cast("string"), F.col("user_id").cast("string"), S.cents("value"), k, F.concat(k, F.lit("7"))
    )
    return S.events(spark, folder).select("event_id", pick_corroborated(candidates, 2).alias("picked"))


def _lag_sql(partition: str) -> str:
    w = f"OVER ({partition} ORDER BY datetime_original, filename)"
    return "WITH " + S.READINGS_SQL + f"""
SELECT filename, CAST(day - lag(day) {w} AS BIGINT) AS days,
  round(price_per_gallon_gtq - lag(price_per_gallon_gtq) {w}, 6) AS change,
  round((price_per_gallon_gtq / nullif(lag(price_per_gallon_gtq) {w}, 0) - 1) * 100, 4) AS pct FROM merged"""


def _lags(spark, folder, entity):
    readings = S.readings(spark, folder)
    corrected = apply_reading_overrides(readings, S.overrides(spark, folder))
    lagged = lag_features(corrected, entity=entity, extent=readings)
    return lagged.select(
        "filename", F.col("days_since_previous_fill").cast("bigint").alias("days"),
        F.round("price_change_gtq", 6).alias("change"), F.round("price_change_pct", 4).alias("pct"),
    )


@query(_lag_sql("PARTITION BY user_id"))
def lag_features_by_user(spark, folder):
    return _lags(spark, folder, ["user_id"])


@query("WITH " + S.READINGS_SQL + """,
m AS (SELECT *, CASE right(filename, 1) WHEN '3' THEN left(datetime_original, 10) WHEN '7' THEN 'unknown'
        WHEN '9' THEN NULL ELSE datetime_original END AS stamp FROM merged),
p AS (SELECT filename, user_id, stamp, price_per_gallon_gtq AS price,
        TRY_CAST(replace(left(stamp, 10), ':', '-') AS DATE) AS on_day FROM m)
SELECT filename, CAST(on_day - lag(on_day) OVER w AS BIGINT) AS days, round(price - lag(price) OVER w, 6) AS change
FROM p WINDOW w AS (PARTITION BY user_id ORDER BY stamp NULLS LAST, filename)""")
def lag_features_gaps(spark, folder):
    """Stamps cut to the day, unreadable or missing: they keep their place in the text order, missing ones last."""
    readings = S.readings(spark, folder)
    last, at = F.right("filename", F.lit(1)), F.col("datetime_original")
    stamped = apply_reading_overrides(readings, S.overrides(spark, folder)).withColumn(
        "datetime_original", F.when(last == "3", F.left(at, F.lit(10))).when(last == "7", "unknown").when(last != "9", at))
    return lag_features(stamped, entity=["user_id"], extent=readings).select(
        "filename", F.col("days_since_previous_fill").cast("bigint").alias("days"),
        F.round("price_change_gtq", 6).alias("change"))


@query(_lag_sql(""))
def lag_features_whole_log(spark, folder):
    return _lags(spark, folder, [])


def _export_sql(partition: str) -> str:
    w = f"OVER ({partition} ORDER BY datetime_original, filename)"
    return S.LOG_SQL + f"""
SELECT filename, user_id, datetime_original, price_per_gallon_gtq, price_diesel_gtq, price_regular_gtq,
  price_super_gtq, price_vpower_gtq, CAST(day AS VARCHAR) AS fecha, dayname(day) AS day_of_week, CAST(month(day) AS INTEGER) AS month,
  isodow(day) >= 6 AS is_weekend, CAST(day - lag(day) {w} AS INTEGER) AS days_since_previous_fill,
  round(price_per_gallon_gtq - lag(price_per_gallon_gtq) {w}, 6) AS price_change_gtq,
  round((price_per_gallon_gtq / nullif(lag(price_per_gallon_gtq) {w}, 0) - 1) * 100, 4) AS price_change_pct,
  o.exchange_rate_usd_gtq, o.official_super_gtq, o.official_regular_gtq, o.official_diesel_gtq,
  round(price_per_gallon_gtq - o.official_super_gtq, 6) AS station_markup_super_gtq
FROM log LEFT JOIN official o ON log.day = o.date"""


EXPORT_SQL = _export_sql("")


def rounded_export(df):
    return df.withColumns({
        "fecha": F.col("fecha").cast("string"),
        "price_change_gtq": F.round("price_change_gtq", 6), "price_change_pct": F.round("price_change_pct", 4),
        "station_markup_super_gtq": F.round("station_markup_super_gtq", 6),
    })


def derived_log(spark, folder):
    return derive_log(
        S.readings(spark, folder), S.overrides(spark, folder), S.board_overrides(spark, folder),
        S.official(spark, folder), staging=scratch_path(spark, "merged"),
    )


@query(_export_sql("PARTITION BY user_id"))
def public_export_by_user(spark, folder):
    stored = write_layer(derived_log(spark, folder), scratch_path(spark, "log"))
    return rounded_export(public_export(stored, S.official(spark, folder), ["user_id"]))
