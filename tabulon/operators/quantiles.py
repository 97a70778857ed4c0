"""Exact quantiles of columns too large for one aggregation buffer.

Quantile sketches first bracket each wanted rank; one counting pass keeps the
values inside the brackets and only tallies the rest; ranks are then resolved
inside the narrow grid slot that holds them. Results equal a full sort with
linear interpolation, but no task ever holds a whole column.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A sketch of this size errs by about a twentieth of a percent of the ranks (one standard
# deviation); brackets are ten times that wide on either side.
SKETCH_SIZE = 4096
_MARGIN = 0.005
_MIN_BRACKETED = 10_000
_SLOTS = 1024
_SUMMARY = pa.schema([
    ("column", pa.string()), ("n", pa.int64()), ("rows", pa.int64()), ("min", pa.float64()), ("max", pa.float64()),
    ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
])


def number(name: str) -> Column:
    """The column as a double, with NaN taken as missing."""
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, weight = 1) of every non-missing value."""
    doubles = df.select(*[number(c).alias(c) for c in columns])
    long = doubles.unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())
    return long.withColumn("weight", F.lit(1).cast("bigint"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, weight) with one row per distinct value, counted map-side first."""
    return long_values(df, columns).groupBy("column", "value").agg(F.sum("weight").alias("weight"))


def _summary(column: str, probabilities: Sequence[float]) -> Column:
    """Aggregate of one column: how many values, and the sketch's values at the ends and around each wanted rank.

    The sketch keeps the extremes and the count exactly.
    """
    sketch = F.kll_sketch_agg_double(number(column), F.lit(SKETCH_SIZE))
    n = F.kll_sketch_get_n_double(sketch)
    ranks = [0.0, 1.0, *[max(0.0, p - _MARGIN) for p in probabilities], *[min(1.0, p + _MARGIN) for p in probabilities]]
    marks = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(r) for r in ranks]))
    return F.struct(n.alias("n"), F.when(n > 0, marks).alias("marks"))


def _ends(marks: Sequence[float], k: int, few: bool) -> tuple[list[float], list[float]]:
    """Where the brackets of a column begin and end: everywhere the extremes if there are few values.

    Few values need no bracket, and the margin has to outweigh single ranks.
    """
    low, high = marks[0], marks[1]
    return ([low] * k, [high] * k) if few else (list(marks[2:2 + k]), list(marks[2 + k:]))


def summarise(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], gate: Column | None = None
) -> DataFrame:
    """(column, n, rows, min, max, lo[], hi[]): one row per column, from a single scan.

    The scan runs at once and its one row passes the driver, a few numbers per
    column: sketches draw at random, so whatever compares with their brackets has
    to see one and the same draw. ``gate`` is an aggregate condition on the whole
    table; while false there are no rows, and none for an empty table.
    """
    passed = F.lit(True) if gate is None else gate
    found = df.agg(
        F.array(*[_summary(c, probabilities) for c in columns]).alias("each"),
        F.count(F.lit(1)).alias("rows"), passed.alias("ok"),
    ).first()
    rows = []
    if found["ok"] and found["rows"]:
        k = len(probabilities)
        for c, s in zip(columns, found["each"]):
            marks = s["marks"] or [None] * (2 + 2 * k)
            lo, hi = _ends(marks, k, (s["n"] or 0) < _MIN_BRACKETED)
            rows.append({"column": c, "n": s["n"] or 0, "rows": found["rows"], "min": marks[0], "max": marks[1],
                         "lo": lo, "hi": hi})
    return df.sparkSession.createDataFrame(pa.Table.from_pylist(rows, _SUMMARY))


def place(counts: DataFrame, summary: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Add ``summary`` and each value's ``band`` and ``slot``; ``held`` is the value inside a bracket, else null.

    Between brackets a band is one slot. Inside, it is cut into even slots.
    """
    known = counts.join(F.broadcast(summary), "column")  # one row per column: bounded by the schema
    v = F.col("value")
    k = len(probabilities)
    opened = sum([(v >= F.col("lo")[i]).cast("int") for i in range(k)], F.lit(0))
    closed = sum([(v > F.col("hi")[i]).cast("int") for i in range(k)], F.lit(0))
    inside = opened > closed
    start, stop = F.get("lo", opened - 1), F.get("hi", closed)
    share = F.coalesce(F.try_divide(v - start, stop - start), F.lit(0.0))
    slot = F.when(inside, F.greatest(F.lit(0), F.least(F.floor(share * _SLOTS), F.lit(_SLOTS - 1))))
    # Never null, so that no null check is pushed below an exchange that two readers share.
    return known.withColumns({
        "band": F.coalesce(opened + closed, F.lit(0)), "slot": F.coalesce(slot, F.lit(0)).cast("int"), "held": F.when(inside, v),
    })


def resolve_quantiles(cells: DataFrame, totals: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(column, n, q[]) with linear interpolation between neighbouring order statistics.

    ``cells`` are placed values with their ``weight``, ``totals`` the sums of the
    weights by (column, n, band, slot): few, so ranking them finds which slots hold
    the wanted ranks, and only those slots' values are put in order.
    """
    spot = [(F.col("n") - 1) * F.lit(p) for p in probabilities]
    targets = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(step).alias("step"),
                 F.least(F.floor(at).cast("bigint") + step, F.col("n") - 1).alias("rank"))
        for i, at in enumerate(spot) for step in (0, 1)
    ])
    running = W.partitionBy("column").orderBy("band", "slot")
    ranked = totals.withColumn("before", F.sum("weight").over(running) - F.col("weight"))
    wanted = (
        ranked.select("column", "band", "slot", "before", (F.col("before") + F.col("weight")).alias("through"),
                      F.inline(targets))
        .filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("through")))
    )
    # At most two targets per wanted quantile and column: bounded by the schema.
    hits = cells.select("column", "n", "band", "slot", "held", "weight").join(
        F.broadcast(wanted), ["column", "band", "slot"])
    within_slot = W.partitionBy("column", "i", "step").orderBy("held")
    upto = F.col("before") + F.sum("weight").over(within_slot)
    found = hits.withColumn("upto", upto).filter(
        (F.col("upto") - F.col("weight") <= F.col("rank")) & (F.col("rank") < F.col("upto"))
    )
    value = F.when(
        F.col("held").isNull(), F.raise_error(F.lit("quantile rank fell outside its bracket")).cast("double")
    ).otherwise(F.col("held"))

    def neighbour(i: int, step: int) -> Column:
        return F.max(F.when((F.col("i") == i) & (F.col("step") == step), F.col("x")))

    return found.withColumn("x", value).groupBy("column", "n").agg(F.array(*[
        neighbour(i, 0) + (neighbour(i, 1) - neighbour(i, 0)) * (at - F.floor(at)) for i, at in enumerate(spot)
    ]).alias("q"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], gate: Column | None = None
) -> DataFrame:
    """(column, n, q[]) for every column that has values; see :func:`summarise` for ``gate``.

    Two scans: one for the brackets, one whose values outside them are only tallied.
    """
    summary = summarise(df, columns, probabilities, gate).select("column", "n", "lo", "hi")
    cells = (
        place(long_values(df, columns), summary, probabilities)
        .groupBy("column", "n", "band", "slot", "held").agg(F.sum("weight").alias("weight"))
    )
    totals = cells.groupBy("column", "n", "band", "slot").agg(F.sum("weight").alias("weight"))
    return resolve_quantiles(cells, totals, probabilities)


def exact_medians(df: DataFrame, columns: Sequence[str], gate: Column | None = None) -> DataFrame:
    """(column, n, median)."""
    return exact_quantiles(df, columns, [0.5], gate).select("column", "n", F.col("q")[0].alias("median"))


def text_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode) of text columns: most frequent, alphabetically first among equals."""
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counted = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("w"))
    best = counted.groupBy("column").agg(F.max("w").alias("w"))
    return (
        counted.join(F.broadcast(best), ["column", "w"])  # one row per column
        .groupBy("column")
        .agg(F.min("value").alias("mode"))
    )
