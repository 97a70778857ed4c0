from __future__ import annotations

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabulon.ml import (
    FAMILIES, InverseStrengthLogisticRegression, TabularPreparer, best_trials, build_model, evaluate_model, load_model, refit, save_model,
    score, search, trials_table, tune,
)
from tabulon.ml.prefixes import prefix_scores
from tabulon.operators import metrics as M
from tabulon.operators.quality import class_rate
from tabulon.operators.split import stratified_folds, stratified_split
from tabulon.plans.churn import ROW_KEY, gold_folder, labelled, split_dataset, to_bronze, to_gold, to_silver
from tabulon.schemas import CHURN, CHURN_CATEGORICAL, CHURN_FEATURES, CHURN_NUMERIC
from tabulon.session import shared_folder
from tabulon.sources.versions import current_version, read_version


def customers(n=240, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        tenure = rng.randint(0, 72)
        monthly = round(rng.uniform(18, 118), 2)
        total = " " if tenure == 0 else str(round(tenure * monthly, 2))
        contract = rng.choice(["Month-to-month", "One year", "Two year"])
        risk = 0.75 if contract == "Month-to-month" and tenure < 24 else 0.15
        text = [rng.choice(["Yes", "No"]) for _ in CHURN_CATEGORICAL]
        text[CHURN_CATEGORICAL.index("Contract")] = contract
        rows.append((f"C{i:04d}", tenure, monthly, total, rng.randint(0, 1), *text, "Yes" if rng.random() < risk else "No"))
    rows += [("C0000", 5, 1.0, "1", 0, *["Dup"] * 15, "No"), ("C9001", -1, 1.0, "1", 0, *["Low"] * 15, "No"),
             ("C9002", 101, 1.0, "1", 0, *["High"] * 15, "No")]
    return rows


@pytest.fixture(scope="module")
def churn_csv(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("churn") / "customers.csv"
    lines = [",".join(CHURN.names)] + [",".join(map(str, r)) for r in customers()]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def layers(spark, churn_csv, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    to_bronze(spark, churn_csv, f"{root}/bronze")
    to_silver(spark, f"{root}/bronze", f"{root}/silver")
    return root


@pytest.fixture(scope="module")
def parts(spark, layers):
    return split_dataset(labelled(read_version(spark, f"{layers}/silver")))


def test_cleaning_and_preparation_end_to_end(spark, layers, parts):
    clean = read_version(spark, f"{layers}/silver")
    assert "customerID" not in clean.columns and clean.count() == 240
    assert clean.filter("tenure NOT BETWEEN 0 AND 100").count() == 0
    assert clean.filter("gender = 'Dup'").count() == 0  # the first row of a repeated customer stays
    train, test = parts
    assert test.count() == math.ceil(0.2 * 240) and train.count() + test.count() == 240
    model = TabularPreparer(CHURN_NUMERIC, CHURN_CATEGORICAL).fit(train)
    sizes = {r["n"] for d in parts for r in model.transform(d).select(F.size(vector_to_array("features")).alias("n")).distinct().collect()}
    assert len(sizes) == 1


def test_preparer_equals_closed_form(spark):
    rows = [(1.0, "a", 5.0, None), (2.0, "b", 5.0, None), (9.0, None, 5.0, None), (20.0, "it's \\ b", 5.0, None), (None, "b", 5.0, None)]
    df = spark.createDataFrame(rows, "`x y` double, c string, flat double, empty double")
    model = TabularPreparer(["x y", "flat", "empty"], ["c"]).fit(df)
    unseen = spark.createDataFrame([(float("nan"), "zzz", None, 1.0)], df.schema)
    out = model.transform(df.union(unseen))
    assert out.columns == [*df.columns, "features"]
    got = [r["f"] for r in out.select(vector_to_array("features").alias("f")).collect()]
    filled = np.array([1, 2, 9, 20, 5.5])
    scaled = (filled - filled.mean()) / filled.std()
    codes = [[1, 0, 0], [0, 1, 0], [0, 1, 0], [0, 0, 1], [0, 1, 0]]
    for g, s, code in zip(got, scaled, codes):
        assert g == pytest.approx([s, 0.0, *code])
    assert got[5] == pytest.approx([(5.5 - filled.mean()) / filled.std(), 0.0, 0, 0, 0])


def test_default_model_learns_scores_and_persists(spark, layers, tmp_path):
    model, metrics = to_gold(spark, f"{layers}/silver", str(tmp_path))
    m = metrics.first().asDict()
    assert set(m) == {"accuracy", "precision", "recall", "f1", "roc_auc"} and all(0 <= v <= 1 for v in m.values())
    assert m["roc_auc"] > 0.6
    stored = gold_folder(spark, str(tmp_path))
    assert spark.read.json(f"{stored}/metrics").count() == 1 and current_version(spark, str(tmp_path))["note"] == {"silver": "1"}
    sample = spark.read.parquet(f"{stored}/test_sample")
    assert sample.count() == 20 and sample.columns == CHURN_FEATURES
    again = score(load_model(f"{stored}/model"), sample).select("score_probability", "score_predicted").collect()
    assert [r[0] for r in again] == pytest.approx([r[0] for r in score(model, sample).select("score_probability").collect()])
    assert all(r["score_predicted"] == (r["score_probability"] >= 0.5) for r in again)


def test_other_estimator_and_evaluation(spark, parts):
    train, test = parts
    model = build_model(RandomForestClassifier(numTrees=5, maxDepth=3, seed=1)).fit(train)
    result = evaluate_model(model, test)
    assert 0 <= result.roc_auc <= 1 and str(result).startswith("accuracy=")
    scored = model.transform(test)
    judge = BinaryClassificationEvaluator(numBins=0)
    assert result.roc_auc == pytest.approx(judge.evaluate(scored), abs=1e-9)


def test_inverse_strength_follows_rows(spark, parts):
    train, _ = parts
    prepared = TabularPreparer(CHURN_NUMERIC, []).fit(train).transform(train)
    model = InverseStrengthLogisticRegression(C=0.1).fit(prepared)
    assert model.getRegParam() == pytest.approx(1 / (0.1 * train.count()))


def test_search_over_folds(spark, parts):
    train = parts[0]
    args = (train, [ROW_KEY], CHURN_NUMERIC, CHURN_CATEGORICAL)
    trials = search(*args, how="random", families=["logistic_regression"], n=2, cv=2)
    assert len(trials) == 2 and all(set(t.settings) == {"C"} and len(t.fold_scores) == 2 for t in trials)
    assert all(0 <= x <= 1 for t in trials for x in t.fold_scores)
    best = best_trials(trials)["logistic_regression"]
    assert best.mean_score == max(t.mean_score for t in trials)
    assert 0 <= evaluate_model(refit(best, train, CHURN_NUMERIC, CHURN_CATEGORICAL), parts[1]).roc_auc <= 1
    table = trials_table(spark, trials).orderBy("rank").collect()
    assert [r["rank"] for r in table] == [1, 2] and table[0]["mean_auc"] >= table[1]["mean_auc"]
    with pytest.raises(ValueError, match="halving"):
        search(*args, how="halving")


def test_grids():
    assert {name: len(f.points()) for name, f in FAMILIES.items()} == {"logistic_regression": 4, "random_forest": 36, "gradient_boosting": 18}
    fits = {name: tune._shared_fits(f, f.points()) for name, f in FAMILIES.items()}
    assert {name: len(g) for name, g in fits.items()} == {"logistic_regression": 4, "random_forest": 12, "gradient_boosting": 9}
    for name, groups in fits.items():
        assert sorted(i for _, same in groups for i in same) == list(range(len(FAMILIES[name].points())))
    assert len(tune.chosen_points(FAMILIES["random_forest"], "random", 5)) == 5


def test_prefixes_of_ensembles(spark, parts):
    prepared = TabularPreparer(CHURN_NUMERIC, CHURN_CATEGORICAL).fit(parts[0])
    fit, held = (prepared.transform(d).select("label", "features").coalesce(1).cache() for d in parts)
    shared_folder(spark)

    def scores(model, size):
        rows = prefix_scores(model, held, [2, size]).filter(F.col("size") == size).collect()
        return [r["score"] for r in rows]

    long = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.2, seed=7).fit(fit)
    for size in (5, 12):  # the first rounds are the model of so many rounds
        alone = GBTClassifier(maxIter=size, maxDepth=3, stepSize=0.2, seed=7).fit(fit)
        want = [r[0] for r in alone.transform(held).select(vector_to_array("rawPrediction")[1]).collect()]
        assert scores(long, size) == pytest.approx(want, abs=1e-9)
    forest = RandomForestClassifier(numTrees=9, maxDepth=30, minInstancesPerNode=2, seed=7).fit(fit)
    want = [r[0] for r in forest.transform(held).select(vector_to_array("probability")[1]).collect()]
    assert scores(forest, 9) == pytest.approx(want, abs=1e-9)
    first = [sum(x) / 4 for x in zip(*[[r[0] for r in t.transform(held).select(vector_to_array("probability")[1]).collect()]
                                       for t in forest.trees[:4]])]
    assert scores(forest, 4) == pytest.approx(first, abs=1e-9)


def test_one_fit_answers_all_sizes(spark, parts, monkeypatch):
    small = {
        "random_forest": replace(FAMILIES["random_forest"], grid={"n_estimators": [3, 6], "max_depth": [None, 3], "min_samples_leaf": [2]}),
        "gradient_boosting": replace(FAMILIES["gradient_boosting"], grid={"n_estimators": [2, 5], "learning_rate": [0.1], "max_depth": [2]}),
        "logistic_regression": FAMILIES["logistic_regression"],
    }
    monkeypatch.setattr(tune, "FAMILIES", small)
    trials = search(parts[0], [ROW_KEY], CHURN_NUMERIC, CHURN_CATEGORICAL, cv=2)
    assert len(trials) == 4 + 2 + 4 and all(len(t.fold_scores) == 2 and 0 <= t.mean_score <= 1 for t in trials)
    ranked = trials_table(spark, trials)
    assert sorted(r["family"] for r in ranked.filter("family_rank = 1").collect()) == sorted(small)


def test_forests_keep_node_ids_and_grow_the_same_trees(spark, parts):
    family = FAMILIES["random_forest"]
    kept = family.classifier({"n_estimators": 5, "max_depth": None, "min_samples_leaf": 2})
    fit = TabularPreparer(CHURN_NUMERIC, CHURN_CATEGORICAL).fit(parts[0]).transform(parts[0]).select("label", "features").coalesce(1).cache()
    assert kept.getCacheNodeIds()
    walked = kept.copy({kept.cacheNodeIds: False})
    grown, again = ([t.toDebugString.split("\n", 1)[1] for t in f.fit(fit).trees] for f in (kept, walked))  # the first line names the object
    assert grown == again


def test_folds_are_spread_over_the_tasks(spark, parts, monkeypatch):
    """A training table of one small file is dealt to as many tasks as run at once, not fitted by one."""
    monkeypatch.setattr(tune, "_LEAST_ROWS", 20)
    train = parts[0].coalesce(1)
    folds = tune.prepared_folds(train, [ROW_KEY], CHURN_NUMERIC, CHURN_CATEGORICAL, cv=2)
    for f in folds:
        sizes = f.fit.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert sum(sizes) + f.held.count() == train.count()
        assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)


@pytest.mark.parametrize("sizes,test_size", [((374, 1035), 0.2), ((5, 2), 0.5), ((10, 1), 0.3), ((3, 3, 3), 0.34)])
def test_split_is_exact_and_storage_independent(spark, sizes, test_size):
    rows = [(f"{c}-{i}", c) for c, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, y int")
    out = stratified_split(df, "y", ["id"], test_size)
    got = {r["id"]: r["split"] for r in out.collect()}
    wanted = math.ceil(sum(sizes) * test_size)
    assert len(got) == len(rows) and sum(s == "test" for s in got.values()) == wanted
    for c, n in enumerate(sizes):
        held = sum(1 for i in range(n) if got[f"{c}-{i}"] == "test")
        assert abs(held - n * wanted / sum(sizes)) < 1
    assert got == {r["id"]: r["split"] for r in stratified_split(df.repartition(7), "y", ["id"], test_size).collect()}
    assert got != {r["id"]: r["split"] for r in stratified_split(df, "y", ["id"], test_size, seed=7).collect()} or len(rows) < 20
    rates = {r["split"]: r["n"] for r in class_rate(out, "split", "y").collect()}
    assert rates["test"] == wanted


def test_folds_deal_classes_evenly(spark):
    df = spark.range(103).selectExpr("id", "CASE WHEN id < 20 THEN 1 ELSE 0 END AS y")
    counts = stratified_folds(df, "y", ["id"], 5).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in counts if r["y"] == 1} == {4} and {r["count"] for r in counts if r["y"] == 0} == {16, 17}


@pytest.mark.parametrize("rows_per_cell", [1, 5, 10**6])
def test_metrics_equal_brute_force(spark, rows_per_cell):
    rng = random.Random(2)
    rows = [(rng.randint(0, 1), rng.choice([0.1, 0.2, 0.5, 0.5, rng.random()])) for _ in range(120)]
    df = spark.createDataFrame(rows, "label int, score double").withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.roc_auc(df, rows_per_cell=rows_per_cell).first()[0] == pytest.approx(auc)
    tp, fp = sum(s >= 0.5 for s in pos), sum(s >= 0.5 for s in neg)
    m = M.threshold_metrics(df).first()
    assert m["precision"] == pytest.approx(tp / (tp + fp)) and m["recall"] == pytest.approx(tp / len(pos))
    grid = {(r["label"], r["prediction"]): r["n"] for r in M.confusion(df).collect()}
    assert grid == {(1, 1): tp, (0, 1): fp, (1, 0): len(pos) - tp, (0, 0): len(neg) - fp}


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, score double")
    assert M.evaluate(df).first().asDict() == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0, "roc_auc": None}


def test_command_line_jobs(spark, churn_csv, tmp_path):
    from tabulon.jobs import main

    main(["bronze", churn_csv, f"{tmp_path}/bronze"])
    main(["silver", f"{tmp_path}/bronze", f"{tmp_path}/silver"])
    assert read_version(spark, f"{tmp_path}/silver").count() == 240
    with pytest.raises(SystemExit):
        main(["unknown"])
