"""Row order without one task per entity.

A window partitioned by entity puts a hot entity into a single task. Here a table of
more than ``rows_per_cell`` rows is cut into cells along (entity, order): the same
total order that the windows use, so cells never change an answer. The cut points
come from Spark's own sample of the sort keys, hence bursts, outliers and missing
values are split as evenly as anything else; only rows equal in every order column
stay together. What has to cross a cell border travels in a summary of a row a cell.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.session import scratch_path
from tabulon.sources.writers import write_layer

#: A task that cuts or walks a cell reads about this many rows, however many the table has.
ROWS_PER_CELL = 250_000
CELL = "_cell"


def cells_for(df: DataFrame, rows_per_cell: int = ROWS_PER_CELL, extent: DataFrame | None = None) -> int:
    """How many cells a table needs; ``extent`` is a cheaper table of at least as many rows to count."""
    return max(1, math.ceil((df if extent is None else extent).count() / rows_per_cell))


def with_cell(df: DataFrame, cells: int, order: Sequence[str], entity: Sequence[str] = ()) -> DataFrame:
    """Add each row's cell number; cells follow (entity, order), nulls of ``order`` last.

    The result is stored: the sampled cut points, and with them the cells, are then
    the same for every reader and after the loss of an executor.
    """
    keys = [*[F.col(e).asc_nulls_first() for e in entity], *[F.col(c).asc_nulls_last() for c in order]]
    dealt = df.repartitionByRange(cells, *keys).withColumn(CELL, F.spark_partition_id())
    return write_layer(dealt, scratch_path(df.sparkSession, "cells"))


def with_previous(
    df: DataFrame,
    values: dict[str, Column],
    order: Sequence[str],
    entity: Sequence[str] = (),
    rows_per_cell: int = ROWS_PER_CELL,
    extent: DataFrame | None = None,
) -> DataFrame:
    """Add, for each name, the value its expression had in the entity's previous row.

    Only the last entity of a cell can go on in a later one, so the last row of each
    cell is copied into the next cell and a single window per (entity, cell) sees its
    predecessor; the copies are then dropped. Rows are ordered by ``order``, nulls last.
    """
    cells = cells_for(df, rows_per_cell, extent)
    inside = [F.col(c).asc_nulls_last() for c in order]
    if cells == 1:
        return df.withColumns({
            name: F.lag(column).over(W.partitionBy(*entity).orderBy(*inside)) for name, column in values.items()
        })
    sources = {f"_src_{name}": column for name, column in values.items()}
    cut = with_cell(df, cells, order, entity).withColumns(sources)
    sort_key = F.struct(*entity, *[part for c in order for part in (F.col(c).isNull(), F.col(c))])
    lasts = cut.groupBy(CELL).agg(F.max_by(F.struct(*entity, *order, *sources), sort_key).alias("_last"))
    carries = (
        lasts.withColumn(CELL, F.lead(CELL).over(W.orderBy(CELL)))  # one row per cell
        .filter(F.col(CELL).isNotNull())
        .select(CELL, "_last.*", F.lit(True).alias("_carry"))
    )
    both = cut.withColumn("_carry", F.lit(False)).unionByName(carries, allowMissingColumns=True)
    window = W.partitionBy(*entity, CELL).orderBy(F.col("_carry").desc(), *inside)
    return (
        both.withColumns({name: F.lag(f"_src_{name}").over(window) for name in values})
        .filter(~F.col("_carry"))
        .drop("_carry", CELL, *sources)
    )


def with_position(
    df: DataFrame,
    order: Sequence[str],
    entity: Sequence[str] = (),
    rows_per_cell: int = ROWS_PER_CELL,
    extra_totals: dict[str, Column] | None = None,
    extent: DataFrame | None = None,
) -> DataFrame:
    """Add ``position`` (from 0) and ``series_rows`` per entity, plus entity-wide totals.

    ``extra_totals`` maps names to ``F.min``/``F.max`` style aggregates that can be
    re-aggregated by the same function over cells; they ride on the same summary.
    """
    extra_totals = extra_totals or {}
    keys = [F.col(c).asc_nulls_last() for c in order]
    whole = W.partitionBy(*entity)
    cells = cells_for(df, rows_per_cell, extent)
    if cells == 1:
        return df.withColumns({
            "series_rows": F.count(F.lit(1)).over(whole),
            **{name: agg.over(whole) for name, agg in extra_totals.items()},
            "position": F.row_number().over(whole.orderBy(*keys)) - 1,
        })
    cut = with_cell(df, cells, order, entity)
    parts = cut.groupBy(*entity, CELL).agg(
        F.count(F.lit(1)).alias("_rows"), *[agg.alias(name) for name, agg in extra_totals.items()]
    )
    before = W.partitionBy(*entity).orderBy(CELL).rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(e).alias(f"_of_{e}") for e in entity],
        F.col(CELL).alias("_of_cell"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("series_rows"),
        *[_reaggregate(name).over(whole).alias(name) for name in extra_totals],
    )
    same = F.col(CELL) == F.col("_of_cell")
    for e in entity:
        same = same & F.col(e).eqNullSafe(F.col(f"_of_{e}"))
    return (
        cut.withColumn("_local", F.row_number().over(W.partitionBy(*entity, CELL).orderBy(*keys)))
        .join(offsets, same)
        .withColumn("position", F.col("_before") + F.col("_local") - 1)
        .drop(CELL, "_local", "_before", "_of_cell", *[f"_of_{e}" for e in entity])
    )


def _reaggregate(name: str) -> Column:
    if name.startswith("min_"):
        return F.min(name)
    if name.startswith("max_"):
        return F.max(name)
    raise ValueError(f"totals must be named min_* or max_*, got {name!r}")


def every_nth(df: DataFrame, ticks: int = 5, position: str = "position", rows: str = "series_rows") -> DataFrame:
    """Keep the rows where an axis of about ``ticks`` labels puts one."""
    step = F.greatest(F.lit(1), F.floor(F.col(rows) / F.lit(ticks)))
    return df.filter(F.col(position) % step == 0)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Plans as a map-side group limit, so a hot key sends one row per task.
    """
    ranked = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def chronological(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending with missing values last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def newest_first(df: DataFrame, *columns: str) -> DataFrame:
    """Descending with missing values last."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in columns])


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows of a stated order: a top-k, not a full sort."""
    return chronological(df, *order).limit(n)
