"""Approximate nearest neighbours: a vantage-point tree per shard, pruned by a relaxed triangle inequality."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import stage
from tabulon.llm.vectors import against_all, in_blocks, matrix, merged, n_blocks, tree_levels, valid_vectors

SHARD_ROWS = 16_384
QUERY_BLOCK = 1024
LEAF_ROWS = 128
FACTOR = 0.7


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances from the differences themselves, in doubles."""
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))


class Tree:
    """A vantage-point tree over one shard.

    A node holds the place of its vantage point, the median distance of its
    other points to it, and two children (inner: at most the median). Points
    are kept in the order of the leaves.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.nodes: list[tuple] = []
        order = np.arange(len(ids))
        self._split(points, order, 0, len(ids), leaf_rows)
        self.ids, self.points = ids[order], points[order]

    def _split(self, points: np.ndarray, order: np.ndarray, lo: int, hi: int, leaf_rows: int) -> int:
        number = len(self.nodes)
        self.nodes.append(("leaf", lo, hi))
        if hi - lo <= leaf_rows:
            return number
        # The point farthest from the first one: near the rim, where distances spread most.
        part = order[lo:hi]
        far = int(np.argmax(((points[part] - points[part[0]]) ** 2).sum(axis=1)))
        part[0], part[far] = part[far], part[0]
        away = np.sqrt(((points[part[1:]] - points[part[0]]) ** 2).sum(axis=1))
        if away.min() == away.max():  # nothing to tell apart: equal points stay a leaf
            return number
        sort = np.argsort(away, kind="stable")
        part[1:] = part[1:][sort]
        away = away[sort]
        half = int(np.searchsorted(away, away[len(away) // 2], side="left"))
        if half == 0:
            half = int(np.searchsorted(away, away[0], side="right"))
        inner_most, outer_least = away[half - 1], away[half]
        middle = lo + 1 + half
        left = self._split(points, order, lo + 1, middle, leaf_rows)
        right = self._split(points, order, middle, hi, leaf_rows)
        self.nodes[number] = ("node", lo, float(inner_most), float(outer_least), left, right)
        return number

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Per query the ids and distances of its nearest found (-1 and inf where fewer).

        A child is visited if its ring, seen from the query, starts nearer than
        ``factor`` times the k-th distance so far. Factor one is the triangle
        inequality itself and the search is exact; below one it prunes more.
        """
        n = len(queries)
        best = np.full((n, k), np.inf)
        ids = np.full((n, k), -1, dtype=np.int64)

        def offer(rows: np.ndarray, lo: int, hi: int, away: np.ndarray) -> None:
            new = np.broadcast_to(self.ids[lo:hi], away.shape)
            away = np.where(new == own[rows][:, None], np.inf, away)
            all_d, all_i = np.hstack([best[rows], away]), np.hstack([ids[rows], np.where(np.isinf(away), -1, new)])
            if all_d.shape[1] > 4 * k:  # only those as near as the k-th can stay
                bar = np.partition(all_d, k - 1, axis=1)[:, k - 1:k]
                width = int((all_d <= bar).sum(axis=1).max())
                width = min(all_d.shape[1], width)
                keep = np.argpartition(all_d, width - 1, axis=1)[:, :width] if width < all_d.shape[1] else None
                if keep is not None:
                    all_d, all_i = np.take_along_axis(all_d, keep, 1), np.take_along_axis(all_i, keep, 1)
            by_id = np.argsort(all_i, axis=1, kind="stable")
            all_d, all_i = np.take_along_axis(all_d, by_id, 1), np.take_along_axis(all_i, by_id, 1)
            by_d = np.argsort(all_d, axis=1, kind="stable")[:, :k]
            best[rows], ids[rows] = np.take_along_axis(all_d, by_d, 1), np.take_along_axis(all_i, by_d, 1)

        def visit(number: int, rows: np.ndarray) -> None:
            node = self.nodes[number]
            if node[0] == "leaf":
                _, lo, hi = node
                step = max(1, 2_000_000 // max(1, (hi - lo) * self.points.shape[1]))
                for at in range(0, len(rows), step):
                    part = rows[at:at + step]
                    for a in range(lo, hi, 4096):
                        b = min(hi, a + 4096)
                        offer(part, a, b, distances(queries[part], self.points[a:b]))
                return
            _, lo, inner_most, outer_least, left, right = node
            away = np.sqrt(((queries[rows] - self.points[lo]) ** 2).sum(axis=1))
            offer(rows, lo, lo + 1, away[:, None])
            to_inner, to_outer = away - inner_most, outer_least - away  # at least so far away are their points
            first = to_inner <= to_outer
            for near, far, near_gap, far_gap, own_rows in (
                    (left, right, to_inner, to_outer, first), (right, left, to_outer, to_inner, ~first)):
                for child, gap in ((near, near_gap), (far, far_gap)):
                    open_ = own_rows & (gap <= factor * best[rows, k - 1])
                    if open_.any():
                        visit(child, rows[open_])

        if n and len(self.ids):
            visit(0, np.arange(n))
        return ids, best


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard and dimension: (``c``, ``dim``, ``tree``). All rows are indexed, none is sampled."""
    shards = n_blocks(rows.count(), shard_rows)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        tree = Tree(table["vec_id"].to_numpy(), matrix(table, key[1].as_py()))
        return pa.table({"c": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([key[1].as_py()], pa.int32()),
                         "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    dealt = in_blocks(rows, "c", shards).select("c", "dim", "vec_id", "vector")
    return dealt.groupBy("c", "dim").applyInArrow(build, "c int, dim int, tree binary")


def nearest(table: DataFrame, k: int = 10, every: int = 100, factor: float = FACTOR,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest rows found for each query (a row whose id is divisible by ``every``), by Euclidean distance.

    Every valid row is in one shard's tree; trees are written to the shared
    folder. Each block of queries meets each shard, and the shards' lists are
    merged by a tree. ``factor`` relaxes the pruning (one: exact search).
    Vectors of different lengths don't meet. Rows with a null id or vector, a
    null or non-finite component, or only zeros take no part; equal rows are
    one; a query's own row is every row with its id. Returns ``query_id, rank, vec_id, score``.
    """
    rows = stage(valid_vectors(table.select("vec_id", "embedding"), nonzero=True), "ann-rows")
    shards = n_blocks(rows.count(), shard_rows)
    index = stage(build_index(rows, shard_rows), "ann-index")
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = n_blocks(asked.count(), QUERY_BLOCK)
    left = against_all(in_blocks(asked, "q", blocks), "c", shards)
    right = against_all(index, "q", blocks)

    def look(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        own, found_q, found_v, found_d = a["vec_id"].to_numpy(), [], [], []
        if len(own) and b.num_rows:
            tree = pickle.loads(b["tree"][0].as_py())
            ids, away = tree.search(matrix(a, key[2].as_py()), own, k, factor)
            row, col = np.nonzero(np.isfinite(away))
            found_q, found_v, found_d = own[row], ids[row, col], away[row, col]
        return pa.table({"query_id": pa.array(found_q, pa.int64()), "part": pa.array([key[1].as_py()] * len(found_q), pa.int32()),
                         "vec_id": pa.array(found_v, pa.int64()), "score": pa.array(found_d, pa.float64())})

    lists = left.groupBy("q", "c", "dim").cogroup(right.groupBy("q", "c", "dim")).applyInArrow(
        look, "query_id long, part int, vec_id long, score double")
    return merged(lists, k, "low", tree_levels(shards))
