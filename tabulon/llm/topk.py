"""Exact top-k by inner product: tiles of queries times tiles of candidates, merged by a tree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import stage_twice
from tabulon.llm.vectors import against_all, in_blocks, matrix, merged, n_blocks, tree_levels, valid_vectors

QUERY_TILE = 2048
CANDIDATE_TILE = 8192
# A dot product of doubles that hold whole numbers is exact while it stays below this.
EXACT = 2.0**53


def best_of_tile(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate, score) of each row's k highest scores, ties to the smaller id.

    ``ids`` ascends, so a stable order by falling score settles ties; candidates
    that bear the query's own id are left out. A row's k-th score is found by
    partial selection first, so only rows' heads are sorted.
    """
    mask = own[:, None] == ids[None, :]
    low = np.iinfo(np.int64).min
    scores = np.where(mask, low, scores)
    n = scores.shape[1]
    if n > k:
        bar = np.partition(scores, n - k, axis=1)[:, n - k]
        row, col = np.nonzero((scores >= bar[:, None]) & ~mask)
    else:
        row, col = np.nonzero(~mask)
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, col = row[place < k], col[place < k]
    return row, ids[col], scores[row, col]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond what doubles hold, in 64-bit integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def exact_top_k(table: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0) -> DataFrame:
    """The ``k`` highest inner products of each query (a row whose id is divisible by ``every``) with all other rows.

    Components become floor(scale * x). Queries and candidates are dealt to
    tiles of bounded size; each pair of tiles is one group, whose product is one
    matrix multiplication with a partial selection, and the lists are merged by
    a tree. Vectors of different lengths don't meet. Rows with a null id or
    vector, or a null or non-finite component, take no part; rows equal after the
    floor are one; a query's own row is every row with its id, and rows that share
    an id share one list. Components beyond what a long holds are taken as the
    nearest long. An empty table gives no lists; other columns are not read. Returns ``query_id, rank, vec_id, score``.
    """
    grid = F.transform("vector", lambda x: F.floor(x * scale).cast("double") + F.lit(0.0))
    rows, asked = stage_twice(valid_vectors(table.select("vec_id", "embedding"), nonzero=False).withColumn("vector", grid).distinct(),
                              "topk-rows")
    asked = asked.filter(F.pmod("vec_id", F.lit(every)) == 0)
    q_tiles, c_tiles = n_blocks(asked.count(), QUERY_TILE), n_blocks(rows.count(), CANDIDATE_TILE)
    left = against_all(in_blocks(asked, "q", q_tiles), "c", c_tiles)
    right = against_all(in_blocks(rows, "c", c_tiles), "q", q_tiles)

    def tile(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        dim = key[2].as_py()
        b = b.sort_by("vec_id")
        q_ids, c_ids = a["vec_id"].to_numpy(), b["vec_id"].to_numpy()
        found: list[tuple] = []
        if len(q_ids) and len(c_ids):
            mine, theirs = matrix(a, dim), matrix(b, dim)
            for at in range(0, len(q_ids), 512):  # bounds the scores held at once
                own = q_ids[at:at + 512]
                row, vec, score = best_of_tile(products(mine[at:at + 512], theirs), c_ids, own, k)
                found.append((own[row], vec, score))
        out = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3)]
        return pa.table({"query_id": out[0], "part": pa.array(np.full(len(out[0]), key[1].as_py()), pa.int32()),
                         "vec_id": out[1], "score": out[2]})

    lists = left.groupBy("q", "c", "dim").cogroup(right.groupBy("q", "c", "dim")).applyInArrow(
        tile, "query_id long, part int, vec_id long, score long")
    return merged(lists, k, "high", tree_levels(c_tiles))
