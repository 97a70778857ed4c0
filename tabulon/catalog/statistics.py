"""Descriptive statistics, quality, correlation, histogram, class balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog.registry import query, table
from tabulon.operators import describe as D
from tabulon.operators.correlate import correlation_matrix, correlation_with
from tabulon.operators.histogram import histogram as equal_width
from tabulon.operators.quality import class_rate, quality_report, value_balance
from tabulon.operators.quantiles import exact_quantiles
from tabulon.operators.select import stack

_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]
# Pairwise gaps: prices of open lines and discounts of returned lines are taken as missing.
_GAPS_SQL = """
WITH g AS (SELECT * REPLACE (CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END AS l_extendedprice,
                             CASE WHEN l_returnflag <> 'R' THEN l_discount END AS l_discount) FROM lineitem)"""


def _gappy(spark, folder):
    return table(spark, folder, "lineitem").withColumns({
        "l_extendedprice": F.when(F.col("l_linestatus") != "O", F.col("l_extendedprice")),
        "l_discount": F.when(F.col("l_returnflag") != "R", F.col("l_discount")),
    })


def _round(df, decimals, *keep):
    return df.select(*[c if c in keep else F.round(c, decimals).alias(c) for c in df.columns])


def _describe_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 8) AS mean,
  round((SELECT {c} FROM g WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)::DOUBLE, 4) AS mode,
  round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
  round(median({c}), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c})::DOUBLE, 4) AS max,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr,
  round(stddev_samp({c}) / nullif(avg({c}), 0), 4) AS cv, round(skewness({c}), 4) AS skew,
  round(kurtosis({c}), 4) AS kurtosis, round(count(*) FILTER ({c} = 0) * 100.0 / count(*), 4) AS zero_pct FROM g"""


@query(_GAPS_SQL + " UNION ALL ".join(_describe_sql(c) for c in _COLUMNS))
def describe_numeric(spark, folder):
    d = D.describe(_gappy(spark, folder))
    return _round(d.withColumn("mean", F.round("mean", 8)), 4, "column", "count", "mean")


@query(_GAPS_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS "count", round(skewness({c}), 4) AS skew, round(kurtosis({c}), 4) AS kurtosis
FROM g""" for c in _COLUMNS))
def moments(spark, folder):
    return _round(D.moments(_gappy(spark, folder)).select("column", "count", "skew", "kurtosis"), 4, "column", "count")


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n, round(quantile_cont({c}, 0.1), 4) AS p10, round(median({c}), 4) AS p50,
  round(quantile_cont({c}, 0.99), 4) AS p99 FROM {t}""" for c, t in [("o_totalprice", "orders"), ("o_custkey", "orders")]))
def quantiles(spark, folder):
    q = F.col("q")
    return exact_quantiles(table(spark, folder, "orders"), ["o_totalprice", "o_custkey"], [0.1, 0.5, 0.99]).select(
        "column", "n", *[F.round(q[i], 4).alias(name) for i, name in enumerate(["p10", "p50", "p99"])]
    )


@query(_GAPS_SQL + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM g" for a in _COLUMNS for b in _COLUMNS))
def corr_matrix(spark, folder):
    return _round(correlation_matrix(_gappy(spark, folder)), 6, "x", "y")


@query(_GAPS_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, l_extendedprice), 6) AS r FROM g"
    for c in _COLUMNS if c != "l_extendedprice"))
def corr_target(spark, folder):
    return _round(correlation_with(_gappy(spark, folder), "l_extendedprice"), 6, "column")


@query("""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
g AS (SELECT l_extendedprice AS x, lo, hi, (hi - lo) / 45.0 AS w,
        CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 45), 44) AS BIGINT) AS g FROM lineitem, s),
p AS (SELECT g - CASE WHEN x < lo + g * w AND g > 0 THEN 1 ELSE 0 END
               + CASE WHEN x >= lo + (g + 1) * w AND g < 44 THEN 1 ELSE 0 END AS b FROM g),
c AS (SELECT b, count(*) AS n FROM p GROUP BY b)
SELECT CAST(i.b AS INTEGER) AS bin, round(lo + i.b * ((hi - lo) / 45.0), 4) AS lower,
       round(lo + (i.b + 1) * ((hi - lo) / 45.0), 4) AS upper, coalesce(n, 0) AS n
FROM range(45) i(b) CROSS JOIN s LEFT JOIN c ON c.b = i.b""")
def histogram(spark, folder):
    return _round(equal_width(table(spark, folder, "lineitem"), "l_extendedprice"), 4, "bin", "n")


def _quality_sql(name: str, key: str, columns: list[str], numeric: int) -> str:
    missing = " + ".join(f"count(*) - count({c})" for c in columns)
    n = len(columns)
    return f"""
SELECT '{name}' AS table_name, count(*) AS n_rows, {n}::BIGINT AS n_columns, {numeric}::BIGINT AS n_numeric,
  {n - numeric}::BIGINT AS n_other, {missing} AS missing_cells,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {name})) AS duplicate_keys,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {name})) AS duplicate_rows FROM {name}"""


@query(" UNION ALL ".join([
    _quality_sql("documents", "text", ["doc_id", "text", "lang", "source", "n_chars"], 2),
    _quality_sql("lineitem", "l_orderkey", _COLUMNS + ["l_returnflag", "l_linestatus", "l_shipdate"], 8),
]))
def dq_report(spark, folder):
    docs = quality_report(table(spark, folder, "documents"), "text").withColumn("table_name", F.lit("documents"))
    lines = quality_report(table(spark, folder, "lineitem"), "l_orderkey").withColumn("table_name", F.lit("lineitem"))
    return stack(docs, lines)


@query("""
WITH c(event_type) AS (VALUES ('click'), ('view'), ('purchase'), ('refund')),
n AS (SELECT event_type, count(*) AS n FROM events JOIN c USING (event_type) GROUP BY event_type)
SELECT event_type, n, round(n * 100.0 / (SELECT sum(n) FROM n), 4) AS pct FROM c LEFT JOIN n USING (event_type)""")
def class_balance(spark, folder):
    balance = value_balance(table(spark, folder, "events"), "event_type", ["click", "view", "purchase", "refund"])
    return _round(balance, 4, "event_type", "n")


@query("SELECT lang, count(*) AS n, round(avg(quality), 6) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def class_rates(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "lang").join(table(spark, folder, "labels"), "doc_id")
    return _round(class_rate(rows, "lang", "quality"), 6, "lang", "n")
