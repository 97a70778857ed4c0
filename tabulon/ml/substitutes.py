"""Substitute search: portions, z-scores, clusters, and nearest rows that keep a rule.

A row's profile is scaled to a common portion and standardised. K-Means cuts the
profiles into clusters, and these are cut into cells of bounded size, each inside a
known box. A query is searched in its own cell first, and then in exactly those whose
box could still hold something better. A task searches its cell the same way, by boxes
of a few hundred rows. So clusters, cells and boxes save work and never change an answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.operators.quantiles import number
from tabulon.session import scratch_path
from tabulon.sources.writers import write_layer

#: Values of one tile of candidates that a task holds at a time.
TILE_VALUES = 1_000_000
#: Rows that K-Means is fitted on at most; every row is assigned and indexed.
FIT_ROWS = 1_000_000
#: A cell is cut until it holds about so many tiles' worth of rows.
CELL_SHARE = 1 / 4
#: Rows that the cuts between cells are taken from at most.
CUT_ROWS = 100_000
#: Rows of one box inside a tile.
BOX_ROWS = 256
#: Queries that a task searches together.
QUERY_ROWS = 8192


@dataclass(frozen=True)
class Scale:
    """Fitted constants of a profile: what is measured, per how much of what, and its spread."""

    columns: tuple[str, ...]
    per: str | None
    amount: float
    means: tuple[float, ...]
    deviations: tuple[float, ...]


@dataclass(frozen=True)
class Boxes:
    """Of each box the least and greatest value of each profile and rule column (NaN: none has a value) and its cluster."""

    low: np.ndarray
    high: np.ndarray
    rule_low: np.ndarray
    rule_high: np.ndarray
    group: np.ndarray

    def away(self, q: np.ndarray) -> np.ndarray:
        """Distance (queries x boxes) that no member is nearer than, but for rounding."""
        total = np.zeros((len(q), len(self.low)))
        for c in range(q.shape[1]):
            x = q[:, c, None]
            total += np.maximum(np.maximum(self.low[None, :, c] - x, x - self.high[None, :, c]), 0.0) ** 2
        return np.sqrt(total)

    def may_keep(self, q_rules: np.ndarray, signs: Sequence[int]) -> np.ndarray:
        """Whether any member can keep the rule (queries x boxes)."""
        out = np.ones((len(q_rules), len(self.low)), dtype=bool)
        with np.errstate(invalid="ignore"):
            for c, sign in enumerate(signs):
                if sign < 0:
                    out &= self.rule_low[None, :, c] < q_rules[:, None, c]
                elif sign > 0:
                    out &= self.rule_high[None, :, c] > q_rules[:, None, c]
        return out


def _beyond(away: np.ndarray, bar: np.ndarray) -> np.ndarray:
    """Boxes that hold nothing as near as the bar; sums of doubles in another order make no difference."""
    with np.errstate(invalid="ignore"):  # an infinite distance is beyond nothing here
        return away - 1e-9 * (1.0 + away) > bar[:, None]


@dataclass(frozen=True)
class SubstituteIndex:
    """All placed rows (``key``, ``group``, ``cell``, ``tile``, ``vector``, ``rule``) and what bounds a search.

    ``cuts`` leads from a cluster to its cells; ``boxes`` has of each cell its cluster and the least and greatest
    value of each column of ``vector`` and ``rule``, ``cell_tiles`` the number of its tiles, ``tiles`` that of a cluster.
    """

    scale: Scale
    rows: DataFrame
    tiles: tuple[int, ...]
    centers: tuple[tuple[float, ...], ...]
    cuts: tuple
    boxes: Boxes
    cell_tiles: tuple[int, ...]
    rule: tuple[str, ...]


def per_portion(df: DataFrame, columns: Sequence[str], per: str, amount: float = 100.0) -> DataFrame:
    """Each column as it is in ``amount`` units of ``per``; null where ``per`` is missing or zero."""
    return df.withColumns({c: F.try_divide(number(c) * amount, F.nullif(number(per), F.lit(0.0))) for c in columns})


def fit_scale(df: DataFrame, columns: Sequence[str], per: str | None = None, amount: float = 100.0) -> Scale:
    """Means and population deviations of the portions, over rows with all of them; one scan, two numbers a column."""
    portions = per_portion(df, columns, per, amount) if per else df
    complete = portions.dropna(subset=list(columns))
    found = complete.agg(*[F.avg(number(c)) for c in columns], *[F.stddev_pop(number(c)) for c in columns]).first()
    means, deviations = found[:len(columns)], found[len(columns):]
    # A spread that rounding alone explains is none.
    flat = [d is None or d <= 1e-12 * abs(m) for m, d in zip(means, deviations)]
    return Scale(tuple(columns), per, amount, tuple(means), tuple(0.0 if f else d for f, d in zip(flat, deviations)))


def z_scores(df: DataFrame, scale: Scale) -> list[Column]:
    """Standardised portions, one column each: 0 for a constant one, null where the portion is missing."""
    portion = [F.try_divide(number(c) * scale.amount, F.nullif(number(scale.per), F.lit(0.0))) if scale.per else number(c)
               for c in scale.columns]
    return [F.when(x.isNotNull(), F.lit(0.0)) if not s else (x - m) / s for x, m, s in zip(portion, scale.means, scale.deviations)]


def _placed(df: DataFrame, key: str, scale: Scale, rule: Sequence[str]) -> DataFrame:
    """(``key``, ``vector``, ``rule``) of rows with a key and a whole profile; one row a key, the least."""
    scores = z_scores(df, scale)
    judged = [scores[scale.columns.index(c)] if c in scale.columns else number(c) for c in rule]
    whole = df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.array(*scores).alias("vector"), F.array(*judged).cast("array<double>").alias("rule"))
    whole = whole.filter(F.forall("vector", lambda x: x.isNotNull()))
    return whole.groupBy("key").agg(F.min(F.struct("vector", "rule")).alias("_r")).select("key", "_r.*")


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda t, x: t + x))


def _literals(values: Sequence[float | int], type_: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{type_}>")


def _nearest_center(centers: Sequence[Sequence[float]], among: Sequence[int]) -> Column:
    """(distance, number) of the nearest centre, the first among equals."""
    return F.array_min(F.array(*[
        F.struct(_distance(F.col("vector"), _literals(centers[g], "double")).alias("d"), F.lit(g).alias("g")) for g in among]))


def fit_substitutes(
    df: DataFrame, key: str, columns: Sequence[str], per: str | None = None, amount: float = 100.0, clusters: int = 16,
    rule: Sequence[str] = (), centers: Sequence[Sequence[float]] | None = None, seed: int = 42, fit_rows: int = FIT_ROWS,
    tile_values: int = TILE_VALUES,
) -> SubstituteIndex:
    """Place every row in its cluster, in a cell of it, and in a tile of bounded size.

    ``columns`` make the profile, each as it is in ``amount`` of ``per`` (None: as it stands); columns that
    summarise others are best left out. ``rule`` names columns that searches may compare; those of the profile are
    compared by portion. ``centers`` gives known clusters, in z-scores, instead of K-Means.

    K-Means sees at most about ``fit_rows`` rows, picked by a hash of the key; all rows are assigned to their
    nearest centre. To the driver come two numbers a column, a centre and a count each cluster, at most about
    ``CUT_ROWS`` vectors to cut cells by, and a box and a count each cell.
    Rows without a key or with any missing portion can't be placed and are left out; of rows that share a key the
    least counts. An empty table gives an index in which nothing is found.
    """
    spark = df.sparkSession
    scale = fit_scale(df, columns, per, amount)
    if any(m is None for m in scale.means):
        scale = Scale(scale.columns, per, amount, (0.0,) * len(columns), (0.0,) * len(columns))
    rows = write_layer(_placed(df, key, scale, rule), scratch_path(spark, "profiles"))
    n = rows.count()
    if centers is None and n:
        picked = rows if n <= fit_rows else rows.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < math.ceil((1 << 20) * fit_rows / n))
        model = KMeans(k=min(clusters, n), seed=seed, featuresCol="_f").fit(picked.select(array_to_vector("vector").alias("_f")))
        centers = [c.tolist() for c in model.clusterCenters()]
    known = tuple(tuple(map(float, c)) for c in centers or [(0.0,) * len(columns)])
    most = max(1, tile_values // max(1, len(columns)))
    rows = write_layer(rows.withColumn("group", _nearest_center(known, range(len(known)))["g"]), scratch_path(spark, "placed"))
    cuts = _fit_cuts(rows, n, len(known), max(1, int(most * CELL_SHARE)))
    rows = write_layer(rows.withColumn("cell", _cell(spark, cuts)), scratch_path(spark, "cells"))
    boxes, counts = _cell_boxes(rows, len(columns), len(rule))
    cell_tiles = tuple(math.ceil(x / most) for x in counts)
    tiles = tuple(sum(t for t, g in zip(cell_tiles, boxes.group) if g == k) for k in range(len(known)))
    tile = F.pmod(F.xxhash64("key"), F.greatest(F.get(_literals(cell_tiles, "int"), F.col("cell")), F.lit(1))).cast("int")
    return SubstituteIndex(scale, rows.withColumn("tile", tile), tiles, known, cuts, boxes, cell_tiles, tuple(rule))


def _split(x: np.ndarray, parts: int, cells: list[int]) -> tuple:
    """A tree of cuts at medians: (cell,) or (column, value, up to it, above it); ``cells`` counts the cells made."""
    if parts > 1 and len(x) > 1:
        column = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
        values = x[:, column]
        value = np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2]
        if value == values.max():
            value = values[values < value].max(initial=-np.inf)
        low = values <= value
        if low.any():
            left = min(parts - 1, max(1, round(parts * low.mean())))
            return column, float(value), _split(x[low], left, cells), _split(x[~low], parts - left, cells)
    cells.append(len(cells))
    return (cells[-1],)


def _fit_cuts(rows: DataFrame, n: int, groups: int, cell_rows: int) -> tuple:
    """Cuts of each cluster into cells of about ``cell_rows`` rows, from the vectors of at most about ``CUT_ROWS`` rows."""
    counts = {r["group"]: r["count"] for r in rows.groupBy("group").count().collect()}
    large = [g for g, c in counts.items() if c > cell_rows]
    drawn: dict[int, np.ndarray] = {}
    if large:
        asked = rows.filter(F.col("group").isin(large))
        if n > CUT_ROWS:
            asked = asked.filter(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 20)) < math.ceil((1 << 20) * CUT_ROWS / n))
        found = asked.select("group", "vector").toPandas()
        drawn = {g: np.array(v.tolist(), dtype=np.float64) for g, v in found.groupby("group")["vector"]}
    cells: list[int] = []
    return tuple(_split(drawn.get(g, np.zeros((0, 1))), math.ceil(counts.get(g, 0) / cell_rows), cells) for g in range(groups))


def _cell(spark: SparkSession, cuts: tuple) -> Column:
    """The cell of a row (``vector``, ``group``)."""
    held = spark.sparkContext.broadcast(cuts)  # a cut a cell

    def place(x: np.ndarray, at: np.ndarray, node: tuple, out: np.ndarray) -> None:
        if len(node) == 1:
            out[at] = node[0]
        elif len(at):
            column, value, low, high = node
            below = x[at, column] <= value
            place(x, at[below], low, out)
            place(x, at[~below], high, out)

    def run(vectors: pd.Series, groups: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), dtype=np.int32)
        if len(vectors):
            x, g = np.stack(vectors.to_numpy()), groups.to_numpy()
            for k in np.unique(g):
                place(x, np.flatnonzero(g == k), held.value[k], out)
        return pd.Series(out)

    return F.pandas_udf(run, "int")("vector", "group")


def _cell_boxes(rows: DataFrame, width: int, n_rules: int) -> tuple[Boxes, list[int]]:
    """Boxes and row counts of all cells up to the last that has rows; a row a cell reaches the driver."""
    ends = [f(F.col(name)[c]).alias(f"{name}{c}{kind}") for name, size in (("vector", width), ("rule", n_rules)) for c in range(size)
            for kind, f in (("low", F.min), ("high", F.max))]
    found = {r["cell"]: r for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.first("group").alias("g"), *ends).collect()}
    cells = max(found, default=-1) + 1

    def values(name: str, size: int, kind: str) -> np.ndarray:
        return np.array([[found[k][f"{name}{c}{kind}"] if k in found else None for c in range(size)] for k in range(cells)],
                        dtype=np.float64).reshape(cells, size)

    group = np.array([found[k]["g"] if k in found else -1 for k in range(cells)], dtype=np.int64)
    boxes = Boxes(values("vector", width, "low"), values("vector", width, "high"), values("rule", n_rules, "low"),
                  values("rule", n_rules, "high"), group)
    return boxes, [found[k]["n"] if k in found else 0 for k in range(cells)]


def _best(ids: np.ndarray, x: np.ndarray, rules: np.ndarray, q_ids: np.ndarray, q: np.ndarray, q_rules: np.ndarray, k: int,
          signs: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, distance) of each query's k nearest candidates that keep the rule, ties to the smaller key.

    A matrix product picks who can be among them; their distances are then taken from the differences.
    """
    squares = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :]
    rough = squares - 2.0 * (q @ x.T)
    barred = q_ids[:, None] == ids[None, :]
    for c, sign in enumerate(signs):
        if sign:
            with np.errstate(invalid="ignore"):
                kept = rules[None, :, c] < q_rules[:, None, c] if sign < 0 else rules[None, :, c] > q_rules[:, None, c]
            barred |= ~kept  # a missing value keeps no rule
    rough[barred] = np.inf
    if rough.shape[1] > k:
        bar = np.partition(rough, k - 1, axis=1)[:, k - 1]
        near = rough <= (bar + 1e-9 * squares.max(axis=1, initial=0.0))[:, None]
    else:
        near = np.ones_like(barred)
    row, col = np.nonzero(near & ~barred)
    away = np.sqrt(((q[row] - x[col]) ** 2).sum(axis=1))
    order = np.lexsort((ids[col], away, row))
    row, col, away = row[order], col[order], away[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k], away[place < k]


class _Tile:
    """Candidates of a tile in boxes of at most ``BOX_ROWS`` rows that lie together."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rules: np.ndarray):
        order, ends = np.arange(len(ids)), []

        def cut(a: int, b: int) -> None:
            if b - a <= BOX_ROWS:
                ends.append((a, b))
                return
            here = x[order[a:b]]
            column, middle = int(np.argmax(here.max(axis=0) - here.min(axis=0))), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(here[:, column], middle)]
            cut(a, a + middle)
            cut(a + middle, b)

        cut(0, len(ids))
        self.ids, self.x, self.rules, self.ends = ids[order], x[order], rules[order], ends
        first = np.array([a for a, _ in ends])
        self.boxes = Boxes(
            np.minimum.reduceat(self.x, first), np.maximum.reduceat(self.x, first), np.fmin.reduceat(self.rules, first),
            np.fmax.reduceat(self.rules, first), np.zeros(len(ends), dtype=np.int64))

    def search(self, q_ids: np.ndarray, q: np.ndarray, q_rules: np.ndarray, bar: np.ndarray, k: int, signs: Sequence[int],
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, candidate row, distance) of each query's k nearest that keep the rule and are within its bar.

        Each round takes the nearest boxes that are left of every query, twice as many as before, until none can
        hold anything as near as the k-th row found.
        """
        away = np.where(self.boxes.may_keep(q_rules, signs), self.boxes.away(q), np.inf)
        near = np.argsort(away, axis=1, kind="stable")
        away = np.take_along_axis(away, near, axis=1)
        row, col, far = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        bar, at, step = bar.copy(), 0, 1
        while at < near.shape[1]:
            part = away[:, at:at + step]
            asks, n = np.nonzero(np.isfinite(part) & ~_beyond(part, bar))
            if not len(asks):
                break  # boxes are in the order of their distance
            box = near[asks, at + n]
            order = np.argsort(box, kind="stable")
            asks, box = asks[order], box[order]
            found = [(row, col, far)]
            for first, last in _runs(box):
                a, b = self.ends[box[first]]
                mine = asks[first:last]
                r, c, d = _best(self.ids[a:b], self.x[a:b], self.rules[a:b], q_ids[mine], q[mine], q_rules[mine], k, signs)
                found.append((mine[r], c + a, d))
            row, col, far = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((self.ids[col], far, row))
            row, col, far = row[order], col[order], far[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, col, far, place = (c[place < k] for c in (row, col, far, place))
            bar[row[place == k - 1]] = np.minimum(bar[row[place == k - 1]], far[place == k - 1])
            at, step = at + step, step * 2
        return row, col, far


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of every run of equal values."""
    edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def _search(index: SubstituteIndex, asked: DataFrame, k: int, signs: Sequence[int]) -> DataFrame:
    """The k best of every tile of the cell that a query (``key``, ``vector``, ``rule``, ``cell``, ``_bar``) is sent to.

    Candidates go to their tile once; a task holds one tile and streams the queries past it. Rows beyond a query's
    ``_bar`` may be left out.
    """
    tiles = F.get(_literals(index.cell_tiles, "int"), F.col("cell"))
    sent = asked.filter(tiles > 0).withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1)))
    columns = ["cell", "tile", "asked", "key", "vector", "rule", "_bar"]
    rows = index.rows.withColumns({"asked": F.lit(False), "_bar": F.lit(0.0)})
    both = rows.select(*columns).unionByName(sent.withColumn("asked", F.lit(True)).select(*columns))
    width, n_rules = len(index.scale.columns), len(index.rule)

    def table(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def square(name: str, n: int) -> np.ndarray:
            return np.array(batch[name].flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(batch.num_rows, n)
        return np.array(batch["key"].to_pylist()), square("vector", width), square("rule", n_rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, tile = None, [], None
        for batch in batches:
            place = [batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("cell", "tile", "asked")]
            for at, to in _runs((place[0] << 32) + (place[1] << 1) + place[2]):
                where, asks = (place[0][at], place[1][at]), place[2][at]
                if where != here:
                    here, held, tile = where, [], None
                if not asks:
                    held.append(table(batch.slice(at, to - at)))
                    continue
                if held:
                    tile, held = _Tile(*(np.concatenate(c) for c in zip(*held))), []
                if tile is None:
                    continue
                for s in range(at, to, QUERY_ROWS):
                    part = batch.slice(s, min(QUERY_ROWS, to - s))
                    q_ids, q, q_rules = table(part)
                    row, col, away = tile.search(q_ids, q, q_rules, part["_bar"].to_numpy(zero_copy_only=False), k, signs)
                    key_type = batch.schema.field("key").type
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_ids[row].tolist(), key_type), pa.array(tile.ids[col].tolist(), key_type), pa.array(away)],
                        names=["query", "found", "distance"])

    dealt = both.repartition("cell", "tile").sortWithinPartitions("cell", "tile", "asked")
    key_type = index.rows.schema["key"].dataType.simpleString()
    return dealt.mapInArrow(run, f"query {key_type}, found {key_type}, distance double")


def _others(index: SubstituteIndex, asked: DataFrame, signs: Sequence[int], within: bool) -> DataFrame:
    """Each query once for every other cell that may hold a row at most ``_bar`` away that keeps the rule.

    ``within``: only cells of the query's own cluster.
    """
    width, n_rules, boxes, full = len(index.scale.columns), len(index.rule), index.boxes, np.array(index.cell_tiles, dtype=np.int64) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                q, rules = (np.array(part[c].flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(part.num_rows, n)
                            for c, n in (("vector", width), ("rule", n_rules)))
                sent = full[None, :] & boxes.may_keep(rules, signs) & ~_beyond(boxes.away(q), part["_bar"].to_numpy(zero_copy_only=False))
                sent &= np.arange(len(full))[None, :] != part["cell"].to_numpy()[:, None]
                if within:
                    sent &= boxes.group[None, :] == part["group"].to_numpy()[:, None]
                row, col = np.nonzero(sent)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [taken["key"], taken["vector"], taken["rule"], pa.array(col, pa.int32()), taken["_bar"]],
                    names=["key", "vector", "rule", "cell", "_bar"])

    key_type = index.rows.schema["key"].dataType.simpleString()
    return asked.select("key", "vector", "rule", "group", "cell", "_bar").mapInArrow(
        run, f"key {key_type}, vector array<double>, rule array<double>, cell int, _bar double")


def _first(lists: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query").orderBy("distance", "found"))
    return lists.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest_substitutes(
    index: SubstituteIndex, k: int = 5, lower: Sequence[str] = (), higher: Sequence[str] = (), queries: DataFrame | None = None,
    key: str | None = None, within: bool = False,
) -> DataFrame:
    """Each query's ``k`` nearest rows that are strictly lower in every column of ``lower`` and higher in ``higher``.

    Queries are the indexed rows, or new ones: ``queries`` with the profile's columns and ``key``, which are scaled
    by the index's constants and go to the cluster of the nearest centre. Returns ``query``, ``rank`` (from 1),
    ``found``, ``distance`` (Euclidean, of z-scores); ties go to the smaller key; a query never finds its own key,
    and one with fewer matching rows has fewer lines.

    With ``within`` only the query's own cluster is searched. A query's own cell comes first; the distance of the
    k-th row found there decides, with the boxes of the other cells, which of these are searched too, so the answer
    is that of a search of all rows. A candidate is shuffled once for each of the two steps; a cell of equal rows
    is many tiles if need be; lists are cut to k in each tile before they meet.
    """
    unknown = [c for c in (*lower, *higher) if c not in index.rule]
    if unknown:
        raise ValueError(f"The index was built without these rule columns: {unknown}")
    spark = index.rows.sparkSession
    signs = [-1 if c in lower else 1 if c in higher else 0 for c in index.rule]
    if queries is None:
        asked = index.rows.select("key", "vector", "rule", "group", "cell")
    else:
        full = sorted(set(index.boxes.group[index.boxes.group >= 0].tolist())) or [0]
        new = _placed(queries, key or "key", index.scale, index.rule)
        placed = new.withColumn("group", _nearest_center(index.centers, full)["g"])
        asked = write_layer(placed.withColumn("cell", _cell(spark, index.cuts)), scratch_path(spark, "asked"))
    anywhere = F.lit(float("inf"))
    near = write_layer(_first(_search(index, asked.withColumn("_bar", anywhere), k, signs), k).drop("rank"), scratch_path(spark, "own-cell"))
    bars = near.groupBy("query").agg(F.when(F.count("*") >= k, F.max("distance")).alias("_b"))
    wide = asked.join(bars, F.col("key") == F.col("query"), "left").withColumn("_bar", F.coalesce("_b", anywhere))
    far = _search(index, _others(index, wide, signs, within), k, signs)
    return _first(near.unionByName(far), k).select("query", "rank", "found", "distance")
