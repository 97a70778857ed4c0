"""Substitute search on part profiles: what the lines of a part hold, per 100,000 of their price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.catalog.registry import query, table
from tabulon.ml.substitutes import fit_scale, fit_substitutes, nearest_substitutes, z_scores

_PROFILE = ["quantity", "discount", "tax", "returned", "size"]
# Given clusters for the search inside a cluster, in z-scores of the profile.
_CENTERS = [(0.0, 0.0, 0.0, 0.0, 0.0), (1.0, 1.0, 1.0, 1.0, 0.0), (-1.0, -1.0, -1.0, -1.0, 0.0), (0.0, 0.0, 0.0, 0.0, 1.5), (0.0, 0.0, 0.0, 1.5, -1.0)]
_NEAREST = 5


def part_totals(spark, folder) -> DataFrame:
    lines = table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"), F.sum("l_discount").alias("discount"), F.sum("l_tax").alias("tax"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"), (F.sum("l_extendedprice") / 1000).alias("price"))
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_size").alias("size"))
    return parts.join(lines, F.col("p_partkey") == F.col("l_partkey")).drop("l_partkey")


_Z_SQL = """
WITH totals AS (
  SELECT p_partkey, any_value(p_size)::DOUBLE AS size, sum(l_quantity) AS quantity, sum(l_discount) AS discount, sum(l_tax) AS tax,
         count(*) FILTER (l_returnflag = 'R')::DOUBLE AS returned, sum(l_extendedprice) / 1000 AS price
  FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey),
portions AS (SELECT p_partkey, """ + ", ".join(f"{c} * 100 / nullif(price, 0) AS {c}" for c in _PROFILE) + """ FROM totals),
z AS (SELECT p_partkey, """ + ", ".join(
    f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}" for c in _PROFILE
) + " FROM portions WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _PROFILE) + ")"


def _away(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in _PROFILE) + ")"


@query(_Z_SQL + " SELECT p_partkey, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _PROFILE) + " FROM z")
def portion_profile(spark, folder):
    """Each part's profile in equal portions, standardised over all parts."""
    totals = part_totals(spark, folder)
    scale = fit_scale(totals, _PROFILE, "price")
    scored = totals.select("p_partkey", *[x.alias(c) for c, x in zip(_PROFILE, z_scores(totals, scale))]).dropna()
    return scored.select("p_partkey", *[(F.round(c, 6) + 0.0).alias(c) for c in _PROFILE])


@query(_Z_SQL + f"""
SELECT q.p_partkey AS query, row_number() OVER (PARTITION BY q.p_partkey ORDER BY {_away('q', 'c')}, c.p_partkey)::INTEGER AS rank,
       c.p_partkey AS found, round({_away('q', 'c')}, 4) AS distance
FROM z AS q JOIN z AS c ON c.p_partkey <> q.p_partkey AND c.discount < q.discount QUALIFY rank <= {_NEAREST}""")
def substitutes(spark, folder):
    """Every part's nearest parts with a lower discount by portion: own cluster first, then those that may hold nearer ones."""
    index = fit_substitutes(part_totals(spark, folder), "p_partkey", _PROFILE, "price", clusters=24, rule=["discount"])
    return nearest_substitutes(index, _NEAREST, lower=["discount"]).withColumn("distance", F.round("distance", 4))


@query(_Z_SQL + f""",
center(g, {', '.join(_PROFILE)}) AS (VALUES {', '.join(str((g, *c)) for g, c in enumerate(_CENTERS))}),
placed AS (SELECT z.*, center.g FROM z, center QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY {_away('z', 'center')}, center.g) = 1)
SELECT q.p_partkey AS query, row_number() OVER (PARTITION BY q.p_partkey ORDER BY {_away('q', 'c')}, c.p_partkey)::INTEGER AS rank,
       c.p_partkey AS found, round({_away('q', 'c')}, 4) AS distance
FROM placed AS q JOIN placed AS c ON q.g = c.g AND c.p_partkey <> q.p_partkey AND c.returned < q.returned AND c.size > q.size
QUALIFY rank <= {_NEAREST}""")
def substitutes_in_cluster(spark, folder):
    """Nearest parts of the same given cluster that are returned less and larger by portion."""
    index = fit_substitutes(part_totals(spark, folder), "p_partkey", _PROFILE, "price", centers=_CENTERS, rule=["returned", "size"])
    near = nearest_substitutes(index, _NEAREST, lower=["returned"], higher=["size"], within=True)
    return near.withColumn("distance", F.round("distance", 4))
