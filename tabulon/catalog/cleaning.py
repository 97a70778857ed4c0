"""Cleaning, coercion, incremental loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog.registry import query, table
from tabulon.functions import to_date_any
from tabulon.operators.clean import keep_plausible
from tabulon.operators.ordering import head
from tabulon.operators.quality import distinct_values, unparsable
from tabulon.operators.select import extract_columns, rename_columns
from tabulon.sources.incremental import reuse_and_new, stale_only, unprocessed

_REST = [
    "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]
CLEAN_SQL = f"""
SELECT {', '.join(c for c in _REST if c != 'l_shipdate')}, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_REST)}) AS rn FROM lineitem)
WHERE rn = 1 AND l_quantity BETWEEN 5 AND 40"""


def cleaned_lines(lines):
    picked = extract_columns(lines, "l_orderkey", _REST)
    kept = keep_plausible(picked, "l_orderkey", "l_quantity", 5, 40, [F.col(c) for c in _REST])
    return kept.withColumn("shipped", F.date_format("l_shipdate", "yyyy-MM-dd")).drop("l_shipdate")


@query(CLEAN_SQL)
def clean_rows(spark, folder):
    return cleaned_lines(table(spark, folder, "lineitem"))


_TEXT_SQL = """
WITH t AS (SELECT p_brand, replace(p_brand, 'Brand#', '') AS brand_no,
                  CASE WHEN p_size > 40 THEN ' ' ELSE CAST(p_size AS VARCHAR) || ' ' END AS size_text,
                  nullif(p_type, 'ECONOMY') AS kind FROM part)"""


def _part_text(spark, folder):
    return table(spark, folder, "part").select(
        "p_brand", F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand_no"),
        F.when(F.col("p_size") > 40, " ").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" "))).alias("size_text"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("kind"),
    )


@query(_TEXT_SQL + "".join(
    f"{' UNION ALL' if i else ''} SELECT '{c}' AS \"column\", count(*) FILTER (TRY_CAST(trim({c}) AS DOUBLE) IS NULL)"
    " AS invalid FROM t" for i, c in enumerate(["p_brand", "brand_no", "size_text"])))
def coerce_quality(spark, folder):
    return unparsable(_part_text(spark, folder), ["p_brand", "brand_no", "size_text"])


@query(_TEXT_SQL + "SELECT DISTINCT kind FROM t")
def distinct_kinds(spark, folder):
    return distinct_values(_part_text(spark, folder), "kind")


@query("""
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderstatus IN ('P', 'F') AND CAST(o_orderdate AS DATE) >= DATE '1998-01-01'""")
def coerce_dates(spark, folder):
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(status == "F", F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise("pending")
    )
    orders = rename_columns(table(spark, folder, "orders").withColumn("text ", text), {"o_orderkey": "id", "text": "raw"})
    return orders.select("id", to_date_any(F.col("raw")).alias("day")).filter(
        F.col("day") >= F.lit("1998-01-01").cast("date")
    ).withColumn("day", F.col("day").cast("string"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20")
def head_orders(spark, folder):
    rows = head(table(spark, folder, "orders"), 20, "o_orderdate", "o_orderkey")
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def _finished(spark, folder):
    o = table(spark, folder, "orders")
    return o.filter("o_orderdate < timestamp_ntz'1998-07-01'"), o


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'")
def incremental_new(spark, folder):
    done, source = _finished(spark, folder)
    return unprocessed(source, done, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("""
SELECT o_orderkey, o_totalprice, 'kept' AS origin FROM orders
WHERE o_orderdate < TIMESTAMP '1998-07-01' AND o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'
  AND o_orderstatus <> 'F'""")
def incremental_merge(spark, folder):
    done, everything = _finished(spark, folder)
    source = everything.filter("o_orderstatus <> 'F'")
    kept = done.select("o_orderkey", "o_totalprice", F.lit("kept").alias("origin"))
    new = unprocessed(source, done, "o_orderkey").select("o_orderkey", "o_totalprice")
    return reuse_and_new(kept, new, source, "o_orderkey")


@query("""
WITH m AS (SELECT l_orderkey, max(l_shipdate) AS done FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey FROM orders LEFT JOIN m ON o_orderkey = l_orderkey WHERE done IS NULL OR done < o_orderdate""")
def incremental_stale(spark, folder):
    manifest = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    return stale_only(table(spark, folder, "orders"), manifest, "o_orderkey", "o_orderdate", "l_shipdate").select(
        "o_orderkey"
    )
