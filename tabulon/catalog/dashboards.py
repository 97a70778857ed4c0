"""Report figures over the reading log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog import standins as S
from tabulon.catalog.readings import derived_log
from tabulon.catalog.registry import query, table
from tabulon.functions import address, join_notes, show_date
from tabulon.operators import dashboard as B
from tabulon.operators.flags import review_queue as waiting
from tabulon.operators.ordering import every_nth, newest_first
from tabulon.operators.overrides import apply_reading_overrides
from tabulon.schemas import BOARD_PRICES
from tabulon.session import scratch_path
from tabulon.sources.writers import write_layer


def _corrected(spark, folder):
    return apply_reading_overrides(S.readings(spark, folder), S.overrides(spark, folder))


def _headline_sql(key: str) -> str:
    by = f"GROUP BY {key}" if key else ""
    pick = f"{key}, " if key else ""
    price = "price_per_gallon_gtq"
    return "WITH " + S.READINGS_SQL + f""",
h AS (SELECT {pick}
    arg_min({{'p': {price}, 'g': gallons}}, datetime_original || filename) FILTER (parse_ok) AS f,
    arg_max({{'p': {price}, 'g': gallons}}, datetime_original || filename) FILTER (parse_ok) AS l,
    avg({price}) FILTER (parse_ok) AS mean_price, count(*) AS n_total,
    count(*) FILTER (data_source = 'ocr') AS n_auto, count(*) FILTER (data_source = 'manual_override') AS n_reviewed
  FROM merged {by})
SELECT {pick} f.p AS first_price, l.p AS latest_price, l.g AS latest_gallons, round(l.p - f.p, 4) AS delta,
  round((l.p - f.p) / nullif(f.p, 0) * 100, 6) AS delta_pct,
  CASE WHEN l.p - f.p > 0 THEN 'up' WHEN l.p - f.p < 0 THEN 'down' ELSE 'flat' END AS trend,
  round(mean_price, 10) AS mean_price, n_total, n_auto, n_reviewed FROM h"""


def _headline(df, entity):
    return B.headline(df, entity).drop("first_at", "latest_at").withColumns(
        {"delta": F.round("delta", 4), "delta_pct": F.round("delta_pct", 6), "mean_price": F.round("mean_price", 10)}
    )


@query(_headline_sql("user_id"))
def kpis_by_user(spark, folder):
    return _headline(_corrected(spark, folder), ["user_id"])


@query(_headline_sql(""))
def kpis(spark, folder):
    return _headline(_corrected(spark, folder), [])


@query(S.LOG_SQL + """
SELECT user_id, count(*) FILTER (needs_review AND data_source <> 'manual_override') AS n_pending,
  count(*) FILTER (board_needs_review) AS n_board_pending FROM log GROUP BY user_id""")
def pending(spark, folder):
    return B.pending_counts(derived_log(spark, folder), ["user_id"])


@query(S.LOG_SQL + """
SELECT user_id, filename, datetime_original, price_diesel_gtq, price_regular_gtq, price_super_gtq, price_vpower_gtq
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY datetime_original DESC, filename DESC) AS rn
      FROM log WHERE NOT board_needs_review) WHERE rn = 1""")
def latest_board(spark, folder):
    return B.latest_confirmed_board(derived_log(spark, folder), ["user_id"])


_CHART_SQL = "WITH " + S.READINGS_SQL + """,
s AS (SELECT filename, user_id, price_per_gallon_gtq AS v,
    row_number() OVER (PARTITION BY user_id ORDER BY datetime_original, filename) - 1 AS position,
    count(*) OVER (PARTITION BY user_id) AS n,
    min(price_per_gallon_gtq) OVER (PARTITION BY user_id) AS lo, max(price_per_gallon_gtq) OVER (PARTITION BY user_id) AS hi
  FROM merged WHERE parse_ok),
a AS (SELECT *, lo - greatest((hi - lo) * 0.25, 1.0) AS axis_low, hi + greatest((hi - lo) * 0.25, 1.0) AS axis_high
      FROM s WHERE n >= 2)
SELECT filename, user_id, position, round(axis_low, 6) AS axis_low, round(axis_high, 6) AS axis_high,
  round(position / (n - 1), 9) AS x, round(1 - (v - axis_low) / (axis_high - axis_low), 9) AS y FROM a"""


def _chart(spark, folder):
    return B.chart_series(_corrected(spark, folder), ["user_id"], extent=S.readings(spark, folder))


@query(_CHART_SQL)
def chart_series(spark, folder):
    return _chart(spark, folder).select(
        "filename", "user_id", "position", F.round("axis_low", 6).alias("axis_low"),
        F.round("axis_high", 6).alias("axis_high"), F.round("x", 9).alias("x"), F.round("y", 9).alias("y"),
    )


@query(_CHART_SQL
       + " WHERE position % greatest(1, n // 5) = 0")
def chart_ticks(spark, folder):
    return every_nth(_chart(spark, folder)).select(
        "filename", "user_id", "position", F.round("axis_low", 6).alias("axis_low"),
        F.round("axis_high", 6).alias("axis_high"), F.round("x", 9).alias("x"), F.round("y", 9).alias("y"),
    )


@query(S.LOG_SQL + """,
u AS (SELECT * FROM (SELECT user_id, filename, datetime_original, price_diesel_gtq, price_regular_gtq, price_super_gtq,
        price_vpower_gtq FROM log)
      UNPIVOT (price FOR fuel IN (price_diesel_gtq, price_regular_gtq, price_super_gtq, price_vpower_gtq))),
s AS (SELECT *, row_number() OVER (PARTITION BY user_id, fuel ORDER BY datetime_original, filename) - 1 AS position,
        count(*) OVER (PARTITION BY user_id, fuel) AS n, min(price) OVER (PARTITION BY user_id, fuel) AS lo,
        max(price) OVER (PARTITION BY user_id, fuel) AS hi FROM u WHERE price IS NOT NULL),
a AS (SELECT *, lo - greatest((hi - lo) * 0.25, 1.0) AS axis_low, hi + greatest((hi - lo) * 0.25, 1.0) AS axis_high
      FROM s WHERE n >= 2)
SELECT filename, user_id, fuel, position, round(axis_low, 6) AS axis_low, round(axis_high, 6) AS axis_high,
  round(position / (n - 1), 9) AS x, round(1 - (price - axis_low) / (axis_high - axis_low), 9) AS y FROM a""")
def board_series(spark, folder):
    """A series per user and fuel, over the rows where that fuel's price is known."""
    log = derived_log(spark, folder).select("user_id", "filename", "datetime_original", *BOARD_PRICES)
    stored = write_layer(log, scratch_path(spark, "board"))
    return B.board_series(stored, ["user_id"]).select(
        "filename", "user_id", "fuel", "position", *[F.round(c, n).alias(c) for c, n in
                                                    (("axis_low", 6), ("axis_high", 6), ("x", 9), ("y", 9))])


@query(S.LOG_SQL + """
SELECT filename, strftime(day, '%d %b %Y') AS shown, review_reason, array_to_string(notes, ';') AS notes
FROM log WHERE needs_review AND data_source <> 'manual_override'""")
def review_queue(spark, folder):
    rows = waiting(derived_log(spark, folder))
    day = F.to_date(F.left("datetime_original", F.lit(10)), "yyyy:MM:dd")
    return newest_first(rows, "datetime_original", "filename").select(
        "filename", show_date(day).alias("shown"), "review_reason", join_notes(F.col("notes")).alias("notes")
    )


@query(S.LOG_SQL + """,
r AS (SELECT *, strptime(datetime_original, '%Y:%m:%d %H:%M:%S') AS ts,
        concat_ws('/', CASE WHEN needs_review AND data_source <> 'manual_override' THEN 'carga' END,
                  CASE WHEN board_needs_review THEN 'tablero' END) AS p FROM log)
SELECT filename, strftime(ts, '%d %b %Y, %H:%M') AS shown_at,
  coalesce('Q' || format('{:,.2f}', total_gtq), '—') AS total, coalesce(format('{:.3f}', gallons), '—') AS gallons,
  'Q' || coalesce(format('{:.4f}', price_per_gallon_gtq), '—') AS price,
  CASE data_source WHEN 'ocr' THEN 'Auto (OCR)' WHEN 'manual_override' THEN 'Reviewed' ELSE 'Failed' END AS badge,
  strftime(ts, '%d %b %Y, %H:%M') || ' — ' || filename || CASE WHEN p <> '' THEN ' · ⚠️ falta ' || p ELSE '' END AS label,
  override_note AS note FROM r""")
def display_rows(spark, folder):
    return B.display_rows(newest_first(derived_log(spark, folder), "datetime_original", "filename"))


@query("""
SELECT c_custkey, concat_ws(', ', nullif(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END, ''),
  nullif(n_name, '')) AS address FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1)
  ON c_nationkey = n_nationkey""")
def addresses(spark, folder):
    known = table(spark, folder, "nation").filter("n_regionkey <> 1")
    c = table(spark, folder, "customer").join(known, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    road = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", address(road, F.col("n_name")).alias("address"))
