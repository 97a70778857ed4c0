"""Vector searches against brute force."""

import math
import random

import numpy as np
import pytest

from tabulon.llm import catalog, topk, vptree


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 3) for _ in range(8)], i) for i in range(400)]
    rows += [(1000 + i, [0.5] * 8, 0) for i in range(60)] + [(2000, [0.0] * 8, 0), (2001, None, 0), (None, [1.0] * 8, 0), (2020, [1.0, None] * 4, 0),
             (2040, [float("nan")] * 8, 0), (2060, [float("inf")] * 8, 0), (2100, [1.0, 2.0], 0), (2101, [2.0, 2.5], 0), (2200, [], 0)]
    return rows + [rows[20], rows[20]]


def usable(rows, nonzero):
    out = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (not nonzero or any(v)):
            out[i] = np.array(v, dtype=np.float32).astype(np.float64)
    return out


def write(spark, rows, path):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(4).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_exact_top_k(spark, vectors, tmp_path, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_TILE", 7)
    monkeypatch.setattr(topk, "CANDIDATE_TILE", 50)
    got = catalog.op9(spark, write(spark, vectors, tmp_path)).collect()
    rows = {i: [math.floor(64 * x) for x in v] for i, v in usable(vectors, False).items()}
    want = set()
    for q in rows:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(rows[q], rows[c])), c) for c in rows if c != q and len(rows[c]) == len(rows[q]))
            want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:20])}
    assert {tuple(r[k] for k in ("query_id", "rank", "vec_id", "score")) for r in got} == want and len(got) == len(want)


def test_repeated_ids_and_no_vectors(spark, tmp_path):
    # Rows that are equal after the floor are one; rows that share an id, but not the floor, share a list.
    rows = [(40, [0.011, 1.0], 0), (40, [0.012, 1.0], 0), (41, [0.5, 0.5], 0), (41, [0.501, 0.5], 0), (42, [1.0, 1.0], 0), (60, [0.0, 1.0], 0), (60, [0.5, 1.0], 0)]
    got = [tuple(r) for r in catalog.op9(spark, write(spark, rows, tmp_path / "a")).collect()]
    floored = sorted({(i, tuple(math.floor(64 * np.float64(np.float32(x))) for x in v)) for i, v, _ in rows})
    want = []
    for q in (40, 60):
        pairs = sorted((-sum(x * y for x, y in zip(a, b)), c) for p, a in floored if p == q for c, b in floored if c != q)
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(pairs[:20])]
    assert sorted(got) == sorted(want)
    empty = write(spark, [], tmp_path / "b")
    assert catalog.op9(spark, empty).count() == 0 and catalog.op10(spark, empty).count() == 0


def test_large_products_stay_exact():
    a, b = np.array([[3.0e9, 1.0]]), np.array([[3.0e9 - 1, 7.0]])
    assert topk.products(a, b)[0, 0] == 3_000_000_000 * 2_999_999_999 + 7


def plain_nearest(rows, k=10):
    want = {}
    for q in rows:
        if q % 100 == 0:
            away = sorted((math.sqrt(((rows[q] - rows[c]) ** 2).sum()), c) for c in rows if c != q and len(rows[c]) == len(rows[q]))
            want[q] = away[:k]
    return want


def test_factor_one_is_exact(spark, vectors, tmp_path):
    table = spark.read.parquet(write(spark, vectors, tmp_path) + "/embeddings.parquet")
    got = vptree.nearest(table, factor=1.0, shard_rows=150).collect()
    want = plain_nearest(usable(vectors, True))
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        away, c = want[r["query_id"]][r["rank"] - 1]
        assert r["vec_id"] == c and r["score"] == pytest.approx(away, abs=1e-12)


def test_relaxed_search_keeps_recall(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 64))
    rows = [(i, (centres[i % 30] + 0.5 * rng.normal(size=64)).tolist(), 0) for i in range(3000)]
    got = catalog.op10(spark, write(spark, rows, tmp_path)).collect()
    want = plain_nearest(usable(rows, True))
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(got) == sum(map(len, want.values()))
    assert sum((q, c) in found for q, w in want.items() for _, c in w) / len(found) >= 0.9
