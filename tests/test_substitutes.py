"""Substitute search against a search of all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.ml.substitutes import BOX_ROWS, _best, _Tile, fit_substitutes, nearest_substitutes, per_portion

COLUMNS = ["fat", "salt", "iron", "same"]


@pytest.fixture(scope="module")
def foods():
    rng = random.Random(1)
    rows = []
    for i in range(400):
        kcal = rng.choice([None, 0.0, 5.0]) if i % 50 == 0 else rng.uniform(10, 500)
        base = kcal or 1.0
        rows.append((f"food {i:03d}", kcal, base * rng.gauss(5, 1) * (1 + i % 4), base * rng.expovariate(1),
                     None if i % 77 == 0 else base * rng.random(), base * 3.0, None if i % 9 == 0 else rng.random()))
    tied = rows[3]
    return rows + [("tie a", *tied[1:]), ("tie b", *tied[1:]), (None, *tied[1:])]


def table(spark, rows):
    return spark.createDataFrame(rows, "food string, kcal double, fat double, salt double, iron double, same double, price double").repartition(5)


def plain(foods, k, keep, asked=None):
    whole = [r for r in foods if r[1] and all(x is not None for x in r[2:6])]
    p = np.array([[x * 100 / r[1] for x in r[2:6]] for r in whole])
    spread = p.std(0)
    spread[spread < 1e-9] = np.inf
    z = (p - p.mean(0)) / spread
    out, named = [], [(r, v) for r, v in zip(whole, z) if r[0] is not None]
    for q, a in named:
        if asked and q[0] not in asked:
            continue
        near = sorted((float(np.sqrt(((a - b) ** 2).sum())), c[0]) for c, b in named if c[0] != q[0] and keep(q, c))
        out += [(q[0], n + 1, c, round(d, 6)) for n, (d, c) in enumerate(near[:k])]
    return sorted(out)


def rows_of(found):
    return sorted((r["query"], r["rank"], r["found"], round(r["distance"], 6)) for r in found.collect())


def test_other_clusters_are_searched_where_the_bound_requires(spark, foods):
    index = fit_substitutes(table(spark, foods), "food", COLUMNS, "kcal", clusters=9, rule=["fat", "price"], tile_values=120)
    assert max(index.tiles) > 1 and len(index.tiles) == 9
    lean = lambda q, c: c[2] / c[1] < q[2] / q[1]
    assert rows_of(nearest_substitutes(index, 4, lower=["fat"])) == plain(foods, 4, lean)
    dear = lambda q, c: lean(q, c) and None not in (q[6], c[6]) and c[6] > q[6]
    assert rows_of(nearest_substitutes(index, 3, lower=["fat"], higher=["price"])) == plain(foods, 3, dear)
    assert rows_of(nearest_substitutes(index, 2)) == plain(foods, 2, lambda q, c: True)
    within = {(q, f) for q, _, f, _ in rows_of(nearest_substitutes(index, 2, within=True))}
    group = {r["key"]: r["group"] for r in index.rows.collect()}
    assert within and all(group[q] == group[f] for q, f in within)
    with pytest.raises(ValueError):
        nearest_substitutes(index, 2, lower=["salt"])


def test_new_rows_are_placed_by_the_index(spark, foods):
    index = fit_substitutes(table(spark, foods), "food", COLUMNS, "kcal", clusters=5)
    asked = ["food 011", "food 222", "food 050"]
    new = table(spark, [r for r in foods if r[0] in asked])
    assert rows_of(nearest_substitutes(index, 3, queries=new, key="food")) == plain(foods, 3, lambda q, c: True, asked)


def test_repeated_keys_empty_tables_and_missing_portions(spark, foods):
    index = fit_substitutes(table(spark, foods).limit(0), "food", COLUMNS, "kcal")
    assert nearest_substitutes(index).count() == 0
    assert nearest_substitutes(index, queries=table(spark, foods[:5]), key="food").count() == 0
    few = table(spark, foods[1:4] + foods[1:4])
    assert nearest_substitutes(fit_substitutes(few, "food", COLUMNS, "kcal"), 5).count() == 6
    portions = per_portion(table(spark, [("x", 0.0, 1.0, 1.0, 1.0, 1.0, 1.0)]), COLUMNS, "kcal")
    assert portions.select(*[F.col(c).isNull() for c in COLUMNS]).first() == (True,) * 4


def test_kmeans_on_a_sample_indexes_every_row(spark, foods):
    index = fit_substitutes(table(spark, foods), "food", COLUMNS, "kcal", clusters=4, fit_rows=60)
    assert rows_of(nearest_substitutes(index, 2)) == plain(foods, 2, lambda q, c: True)


def test_a_tile_is_searched_by_boxes_and_finds_the_same(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(4000, 3)), np.zeros((600, 3))])  # many rows alike
    ids, rules = rng.permutation(len(x)), np.where(rng.random((len(x), 1)) < 0.1, np.nan, x[:, :1])
    asked = rng.choice(len(x), 500)
    pairs = 0

    def counted(*a):
        nonlocal pairs
        pairs += len(a[0]) * len(a[3])
        return _best(*a)

    for signs in ([0], [-1], [1]):
        row, col, away = _best(ids, x, rules, ids[asked], x[asked], rules[asked], 5, signs)
        want = [(q, int(ids[c]), round(float(d), 9)) for q, c, d in zip(row, col, away)]
        tile = _Tile(ids, x, rules)
        assert max(b - a for a, b in tile.ends) <= BOX_ROWS
        monkeypatch.setattr("tabulon.ml.substitutes._best", counted)
        row, col, away = tile.search(ids[asked], x[asked], rules[asked], np.full(len(asked), np.inf), 5, signs)
        monkeypatch.undo()
        assert [(q, int(tile.ids[c]), round(float(d), 9)) for q, c, d in zip(row, col, away)] == want
    assert pairs < 3 * len(x) * len(asked) / 2


def test_large_clusters_are_cut_into_cells_in_space(spark, foods):
    index = fit_substitutes(table(spark, foods), "food", COLUMNS, "kcal", clusters=2, rule=["fat"], tile_values=400)
    sizes = [r["count"] for r in index.rows.groupBy("cell").count().collect()]
    assert len(sizes) > 8 and max(sizes) <= 100
    lean = lambda q, c: c[2] / c[1] < q[2] / q[1]
    assert rows_of(nearest_substitutes(index, 4, lower=["fat"])) == plain(foods, 4, lean)
    one = {r["key"]: r["group"] for r in index.rows.collect()}
    near = [r for r in plain(foods, 400, lean) if one[r[0]] == one[r[2]]]
    want, seen = [], {}
    for q, _, f, d in near:
        seen[q] = seen.get(q, 0) + 1
        if seen[q] <= 3:
            want.append((q, seen[q], f, d))
    assert rows_of(nearest_substitutes(index, 3, lower=["fat"], within=True)) == sorted(want)
