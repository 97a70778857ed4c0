"""Exact splits and folds against sorting, with bounded remainders, ties and odd classes."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tabulon.operators import split as S


def plain_order(rows):
    return sorted(rows, key=lambda r: hashlib.md5(f"42|{r[0]}".encode()).hexdigest())


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, "ab"[i % 7 == 0] if i % 11 else None) for i in range(4000)] + [(5000, "lone")]
    return rows, spark.createDataFrame(rows, "id long, y string").repartition(6).cache()


@pytest.mark.parametrize("limit", [5, 40, 20_000])
def test_split_and_folds_equal_a_sort(spark, table, limit):
    rows, df = table
    got = {r["id"]: r["split"] for r in S.stratified_split(df, "y", ["id"], ranked_rows=limit).collect()}
    folds = {r["id"]: r["fold"] for r in S.stratified_folds(df, "y", ["id"], 7, ranked_rows=limit).collect()}
    quotas = {r["_class"]: r["_quota"] for r in S.class_quotas(df, "y", 0.2).collect()}
    known = [r for r in rows if r[1]]
    assert sum(quotas.values()) == math.ceil(0.2 * len(known)) and len(got) == len(folds) == len(rows)
    for c in ("a", "b", "lone"):
        order = plain_order([r for r in rows if r[1] == c])
        ends = [math.ceil((f + 1) * len(order) / 7) for f in range(7)]
        for n, (i, _) in enumerate(order, 1):
            assert got[i] == ("test" if n <= quotas[c] else "train")
            assert folds[i] == next(f for f, e in enumerate(ends) if n <= e)
    assert {got[i] for i, c in rows if c is None} == {folds[i] for i, c in rows if c is None} == {None}


def test_only_a_bounded_remainder_is_sorted(spark, table):
    rows, df = table
    keyed = df.filter("y is not null").withColumn("_order", S.hash_order(["id"], 42))
    found = S.refined(keyed, "y", {"a": [1, 700, 1500], "b": [300]}, ranked_rows=5)
    hashes = {c: [hashlib.md5(f"42|{i}".encode()).hexdigest() for i, y in rows if y == c] for c in "ab"}
    for (c, n), (prefix, before, under) in found.items():
        rank = {"a": [1, 700, 1500], "b": [300]}[c][n]
        assert under == sum(h.startswith(prefix) for h in hashes[c]) <= 5
        assert before == sum(h < prefix for h in hashes[c]) < rank <= before + under


def test_rows_that_share_a_key_still_fill_the_quota(spark):
    df = spark.createDataFrame([(i % 3, i, "x") for i in range(90)], "id long, other int, y string")
    for limit in (4, 20_000):
        out = S.stratified_split(df, "y", ["id"], 0.5, ranked_rows=limit)
        assert out.filter("split = 'test'").count() == 45 and out.count() == 90
        again = S.stratified_split(df.repartition(5), "y", ["id"], 0.5, ranked_rows=limit)
        assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
        folds = S.stratified_folds(df, "y", ["id"], 4, ranked_rows=limit).groupBy("fold").count().collect()
        assert sorted(r["count"] for r in folds) == [22, 22, 23, 23]


def test_no_rows_and_no_labels(spark):
    empty = spark.createDataFrame([], "id long, y int")
    assert S.stratified_split(empty, "y", ["id"]).count() == 0 and S.stratified_folds(empty, "y", ["id"]).count() == 0
    none = spark.range(5).withColumn("y", F.lit(None).cast("int"))
    assert S.stratified_split(none, "y", ["id"]).filter("split is null").count() == 5
    few = spark.createDataFrame([(1, 0), (2, 1)], "id long, y int")
    assert sorted(r["fold"] for r in S.stratified_folds(few, "y", ["id"], 5).collect()) == [0, 0]
