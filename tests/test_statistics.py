from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.operators import describe as D
from tabulon.operators import quantiles as Q
from tabulon.operators.correlate import correlation_matrix, correlation_with
from tabulon.operators.histogram import histogram
from tabulon.operators.quality import (
    distinct_values, quality_report, surplus_rows, type_breakdown, unparsable, value_balance,
)
from tabulon.plans.nutrition import profile


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(3)
    n = 30_000
    df = pd.DataFrame({
        "normal": rng.normal(size=n), "heavy": rng.lognormal(0, 6, n), "ties": rng.integers(0, 4, n).astype(float),
        "hot": np.where(rng.random(n) < 0.6, 7.0, rng.random(n) * 1e9), "same": np.full(n, 3.3),
        "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.normal(5, 2, n)),
    })
    df.loc[0, "Odd Name"] = 1.0
    return df


def close(a, b):
    if b is None or (isinstance(b, float) and math.isnan(b)):
        return a is None or math.isnan(a)
    return a == pytest.approx(b, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("threshold", [10_000, 100])
def test_describe_equals_pandas(spark, numbers, monkeypatch, threshold):
    monkeypatch.setattr(Q, "_MIN_BRACKETED", threshold)
    got = D.describe(spark.createDataFrame(numbers).repartition(5)).toPandas().set_index("column")
    want = numbers.describe().T
    for c in numbers.columns:
        g, w = got.loc[c], want.loc[c]
        pairs = [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("median", "50%"),
                 ("p75", "75%"), ("max", "max")]
        for a, b in pairs:
            assert close(g[a], w[b]) or (c == "same" and a == "std"), (c, a)
        assert close(g["mode"], numbers[c].mode().iloc[0]), c
        assert close(g["iqr"], w["75%"] - w["25%"])
        assert close(g["zero_pct"], (numbers[c] == 0).mean() * 100)
        if c != "same":
            assert g["skew"] == pytest.approx(numbers[c].skew(), rel=1e-6, nan_ok=True), c
            assert g["kurtosis"] == pytest.approx(numbers[c].kurtosis(), rel=1e-6, nan_ok=True), c
    assert (got.loc["same", "std"], got.loc["same", "skew"], got.loc["same", "kurtosis"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 50])
def test_small_quantiles(spark, n):
    values = np.random.default_rng(n).integers(0, 10, n).astype(float)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    q = Q.exact_quantiles(df, ["v"], probabilities).first()["q"]
    assert q == pytest.approx(list(np.quantile(values, probabilities)))


def test_gate_and_empty(spark):
    empty = spark.createDataFrame([], "v double")
    assert Q.exact_medians(empty, ["v"]).count() == 0
    assert D.describe(empty).first()["count"] == 0 if D.describe(empty).count() else True


def test_correlation_equals_pandas(spark, numbers):
    df = spark.createDataFrame(numbers).repartition(3)
    want = numbers.corr()
    for r in correlation_matrix(df).collect():
        w = want.loc[r["x"], r["y"]]
        assert r["r"] == pytest.approx(w, abs=1e-9) if r["r"] is not None else (math.isnan(w) or "same" in (r["x"], r["y"]))
    ranked = correlation_with(df, "normal").collect()
    known = [r["r"] for r in ranked if r["r"] is not None]
    assert known == sorted(known, reverse=True) and "normal" not in {r["column"] for r in ranked}


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 10.0], [5.0, 5.0], [0.1 * i for i in range(46)], [-1.0, 0.0, 1.0]])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    rows = histogram(df, "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=45)
    assert [r["n"] for r in rows] == list(counts)
    assert [r["lower"] for r in rows] == pytest.approx(list(edges[:-1]))


def test_quality(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "1"), ("a", 1.0, "1"), (None, float("nan"), " "), (None, None, "x"), ("b", 2.0, None)],
        "k string, v double, t string",
    )
    r = quality_report(df, "k").first().asDict()
    assert r == {"n_rows": 5, "n_columns": 3, "n_numeric": 1, "n_other": 2, "missing_cells": 5, "duplicate_keys": 2, "duplicate_rows": 1}
    assert surplus_rows(df.limit(0)).first()[0] == 0
    assert unparsable(df, ["t"]).first()["invalid"] == 3
    assert {x["k"] for x in distinct_values(df, "k").collect()} == {"a", "b", None}
    assert {x["type"]: x["columns"] for x in type_breakdown(df).collect()} == {"string": 2, "double": 1}
    balance = {x["k"]: (x["n"], x["pct"]) for x in value_balance(df, "k", ["a", "c"]).collect()}
    assert balance == {"a": (2, 100.0), "c": (None, None)}


def test_profile_of_wide_table(spark):
    rng = np.random.default_rng(1)
    names = ["Caloric Value", "Fat", "Nutrition Density", *[f"Nutrient {i}" for i in range(31)]]
    df = pd.DataFrame(rng.random((60, 34)), columns=names)
    df.insert(0, "food", [f"f{i % 55}" for i in range(60)])
    df.insert(0, "Unnamed: 0", range(60))
    tables = profile(spark.createDataFrame(df))
    assert tables["statistics"].count() == 34
    assert tables["correlations"].count() == 34 * 34
    assert tables["quality"].first()["duplicate_keys"] == 5
    assert tables["histogram"].count() == 45
    assert tables["correlation with Caloric Value"].count() == 33


def file_scans(df):
    """How many file scans the final plan runs; exchanges that are reused scan once."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return final.count("FileScan")


def test_describe_is_one_sketch_scan_and_one_counting_scan(spark, tmp_path):
    rng = np.random.default_rng(5)
    n = 60_000
    data = pd.DataFrame({
        "wide": rng.normal(1e6, 3.0, n), "few": rng.integers(0, 5, n).astype(float), "gone": np.nan,
        "rare": np.where(np.arange(n) < 7, np.arange(n), np.nan), "same": 2.0,
    })
    path = str(tmp_path / "t")
    spark.createDataFrame(data).repartition(5).write.parquet(path)
    got_df = D.describe(spark.read.parquet(path))
    assert file_scans(got_df) == 1  # the sketch scan has run by now
    got = got_df.toPandas().set_index("column")
    for c in ("wide", "few", "rare", "same"):
        x = data[c].dropna()
        want = [x.mean(), x.std(), x.min(), *x.quantile([0.25, 0.5, 0.75]), x.max(), x.mode()[0], (x == 0).sum() / n * 100]
        have = got.loc[c, ["mean", "std", "min", "p25", "median", "p75", "max", "mode", "zero_pct"]].astype(float)
        np.testing.assert_allclose(have, want, rtol=1e-9, atol=1e-9)
        if c != "same":
            np.testing.assert_allclose(got.loc[c, ["skew", "kurtosis"]].astype(float), [x.skew(), x.kurt()], atol=1e-6)
    assert got.loc["gone", "count"] == 0 and pd.isna(got.loc["gone", "mean"]) and pd.isna(got.loc["gone", "mode"])
    assert D.describe(spark.read.parquet(path).limit(0)).count() == 0


def test_medians_take_one_counting_scan_and_no_rows_while_gated(spark, tmp_path):
    x = np.random.default_rng(6).exponential(10, 50_000)
    path = str(tmp_path / "t")
    spark.createDataFrame(pd.DataFrame({"x": x})).repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    medians = Q.exact_medians(df, ["x"])
    assert file_scans(medians) == 1
    assert medians.first()["median"] == np.median(x)
    assert Q.exact_medians(df, ["x"], F.count("*") > 50_000).count() == 0
