"""Sharding by a Feistel permutation of global row numbers, with cycle walking."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import running_start

ROUNDS = 6


def permute(x: Column, n: Column | int, *keys: Column | int) -> Column:
    """Where number ``x`` of 0..n-1 lands under a keyed pseudorandom permutation of 0..n-1.

    The network works on the grid of a = ceil(sqrt(n)) by b = ceil(n / a) cells,
    changing the row by a hash of the column and the column by a hash of the row
    in turn. Numbers that land on the a*b - n spare cells walk on until they
    leave them; a walk meets each spare cell at most once, so that many steps
    are always enough and only the few rows on spare cells take any.
    """
    n = (F.lit(n) if isinstance(n, int) else n).cast("long")
    keys = tuple(F.lit(k) if isinstance(k, int) else k for k in keys)
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("long")
    b = F.greatest(F.ceil(n / a), F.lit(1)).cast("long")

    def one_round(side: Column, r: Column) -> Column:
        row, col = side["row"], side["col"]
        even = r % 2 == 0
        return F.struct(
            F.when(even, F.pmod(row + F.pmod(F.xxhash64(col, r, *keys), a), a)).otherwise(row).alias("row"),
            F.when(even, col).otherwise(F.pmod(col + F.pmod(F.xxhash64(row, r, *keys), b), b)).alias("col"),
        )

    def once(v: Column) -> Column:
        start = F.struct(F.floor(v / b).cast("long").alias("row"), F.pmod(v, b).alias("col"))
        rounds = F.array(*[F.lit(r) for r in range(ROUNDS)])
        return F.aggregate(rounds, start, one_round, lambda side: side["row"] * b + side["col"])

    first = once(x.cast("long"))
    spare = F.greatest(a * b - n, F.lit(1))
    walk = F.aggregate(F.sequence(F.lit(1).cast("long"), spare), F.lit(0).cast("long") + first,
                       lambda at, _: F.when(at < n, at).otherwise(once(at)))
    return F.when(first < n, first).otherwise(walk)


def shard_rows(rows: DataFrame, n_shards: int, seed: int = 7, rows_per_bucket: int = 50_000) -> DataFrame:
    """Deal all rows to ``n_shards`` shards in a reproducible shuffled order.

    Every row gets a global row number (its place in the order of a hash of its
    values), the number is permuted, and place p goes to slot p div n of shard
    p mod n: shard sizes differ by one row at most and slots have no gaps. Equal
    rows are interchangeable; they are counted before the shuffle and numbered in
    bounded stretches. Columns ``row_number``, ``shard`` and ``slot`` are added, in
    place of input columns of those names. Nulls are ordinary values; texts of any
    length only take part as the values of their row; an empty table gives an empty one.
    """
    names = [c for c in rows.columns if c not in ("row_number", "shard", "slot")]
    n = rows.count()
    each = running_start(rows.select(F.struct(*names).alias("_row")), [], F.lit(1), ["_row"], "row_number",
                         max(1, math.ceil(n / rows_per_bucket)))
    placed = each.withColumn("_p", permute(F.col("row_number"), max(n, 1), seed))
    return placed.select(
        *[F.col("_row")[c].alias(c) for c in names], "row_number",
        F.pmod("_p", F.lit(n_shards)).cast("int").alias("shard"),
        F.floor(F.col("_p") / n_shards).cast("long").alias("slot"),
    )
