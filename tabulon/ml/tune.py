"""Search over classifier settings by stratified cross-validation on ROC AUC."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.ml.models import DEFAULT_SEED, InverseStrengthLogisticRegression, build_model
from tabulon.ml.prefixes import prefix_scores
from tabulon.ml.prepare import TabularPreparer
from tabulon.operators.split import stratified_folds
from tabulon.session import scratch_path, shared_folder
from tabulon.sources.writers import write_layer

_UNLIMITED_DEPTH = 30  # the deepest tree Spark grows
#: Rows of a training table that are worth a task of their own, and rows of one task at most.
_LEAST_ROWS, _MOST_ROWS = 10_000, 1_000_000


@dataclass(frozen=True)
class Family:
    """A kind of classifier: how to make one, what to try, and the Spark parameter behind each setting.

    ``size`` names the setting that counts trees: models that differ only in it share one fit.
    """

    make: Callable[[], Estimator]
    grid: dict[str, list]
    parameters: dict[str, str]
    size: str | None = None

    def points(self) -> list[dict]:
        return [dict(zip(self.grid, values)) for values in product(*self.grid.values())]

    def classifier(self, settings: dict) -> Estimator:
        made = self.make()
        values = {k: _UNLIMITED_DEPTH if k == "max_depth" and v is None else v for k, v in settings.items()}
        return made.copy({made.getParam(self.parameters[k]): v for k, v in values.items()})


# The candidate models and the values searched for each.
FAMILIES: dict[str, Family] = {
    "logistic_regression": Family(
        lambda: InverseStrengthLogisticRegression(maxIter=1000),
        {"C": [0.01, 0.1, 1, 10]},
        {"C": "C"},
    ),
    "random_forest": Family(
        # Kept node ids give the same trees: a row steps down one level a pass, instead of from the root again.
        lambda: RandomForestClassifier(seed=DEFAULT_SEED, cacheNodeIds=True),
        {"n_estimators": [100, 200, 400], "max_depth": [None, 5, 10, 20], "min_samples_leaf": [1, 2, 4]},
        {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"},
        "n_estimators",
    ),
    "gradient_boosting": Family(
        lambda: GBTClassifier(seed=DEFAULT_SEED),
        {"n_estimators": [100, 200], "learning_rate": [0.01, 0.1, 0.2], "max_depth": [2, 3, 4]},
        {"n_estimators": "maxIter", "learning_rate": "stepSize", "max_depth": "maxDepth"},
        "n_estimators",
    ),
}


@dataclass(frozen=True)
class Trial:
    """One point of a family's grid and its score on each fold."""

    family: str
    settings: dict
    fold_scores: tuple[float, ...]

    @property
    def mean_score(self) -> float:
        return sum(self.fold_scores) / len(self.fold_scores)


@dataclass(frozen=True)
class Fold:
    """Prepared rows of one fold: fitted on, and held out."""

    fit: DataFrame
    held: DataFrame


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``df`` dealt evenly to as many tasks as run at once, however its files were cut: trainers pass over it hundreds of times."""
    at_once = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(math.ceil(rows / _LEAST_ROWS), at_once), math.ceil(rows / _MOST_ROWS)))


def prepared_folds(
    train: DataFrame, key: Sequence[str], numeric: Sequence[str], categorical: Sequence[str], cv: int = 5, seed: int = DEFAULT_SEED,
) -> list[Fold]:
    """Stored vectors of every fold, prepared by what the fold's own training rows say; all families share them."""
    spark = train.sparkSession
    shared_folder(spark)  # long boosting runs cut their lineage there
    dealt = write_layer(spread(stratified_folds(train, "label", key, cv, seed), train.count()), scratch_path(spark, "folds"))
    out = []
    for fold in range(cv):
        rows = dealt.filter(f"fold <> {fold}")
        prepared = TabularPreparer(numeric, categorical).fit(rows)
        fit, held = (write_layer(prepared.transform(d).select("label", "features"), scratch_path(spark, "vectors"))
                     for d in (rows, dealt.filter(f"fold = {fold}")))
        out.append(Fold(fit, held))
    return out


def chosen_points(family: Family, how: str = "grid", n: int = 20, seed: int = DEFAULT_SEED) -> list[dict]:
    """All points of the grid, or a seeded sample of ``n`` of them ('random'), none twice."""
    points = family.points()
    if how == "grid":
        return points
    if how == "random":
        return random.Random(seed).sample(points, min(n, len(points)))
    raise ValueError(f"A search is 'grid' or 'random', not {how!r}")


def _shared_fits(family: Family, points: Sequence[dict]) -> list[tuple[dict, list[int]]]:
    """(settings of the longest model, points it answers): points that differ in size only go together."""
    groups: dict[tuple, list[int]] = {}
    for i, settings in enumerate(points):
        rest = tuple((k, v) for k, v in settings.items() if k != family.size)
        groups.setdefault(rest if family.size else (i,), []).append(i)
    if not family.size:
        return [(points[i], [i]) for (i,) in groups.values()]
    return [(max((points[i] for i in same), key=lambda s: s[family.size]), same) for same in groups.values()]


def _judge(scored: DataFrame, column: str) -> float:
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=column, metricName="areaUnderROC", numBins=0).evaluate(scored)


def _score_fit(family: Family, longest: dict, points: Sequence[dict], fold: Fold) -> list[float]:
    """Held-out ROC AUC of each point that one fit answers."""
    model = family.classifier(longest).fit(fold.fit)
    if not family.size:
        return [_judge(model.transform(fold.held), "rawPrediction")]
    sizes = [p[family.size] for p in points]
    scored = prefix_scores(model, fold.held, sizes).cache()
    try:
        return [_judge(scored.filter(F.col("size") == s), "score") for s in sizes]
    finally:
        scored.unpersist()


def cross_validate(spark: SparkSession, wanted: dict[str, Sequence[dict]], folds: Sequence[Fold], at_once: int = 4) -> list[Trial]:
    """Every wanted point of every family on every fold; ``at_once`` fits run side by side.

    58 points of three families take 25 fits a fold: 4 regressions, 12 forests and 9 boosted models.
    """
    tasks = [(name, longest, same, f) for name, points in wanted.items()
             for longest, same in _shared_fits(FAMILIES[name], points) for f in range(len(folds))]
    found: dict[tuple[str, int, int], float] = {}

    def run(task: tuple) -> None:
        name, longest, same, f = task
        points = [wanted[name][i] for i in same]
        for i, score in zip(same, _score_fit(FAMILIES[name], longest, points, folds[f])):
            found[name, i, f] = score

    # The slowest kind first, so that the last fits are short.
    order = {"gradient_boosting": 0, "random_forest": 1}
    with ThreadPool(max(1, at_once)) as pool:
        pool.map(inheritable_thread_target(spark)(run), sorted(tasks, key=lambda t: order.get(t[0], 2)), chunksize=1)
    return [Trial(name, dict(p), tuple(found[name, i, f] for f in range(len(folds))))
            for name, points in wanted.items() for i, p in enumerate(points)]


def search(
    train: DataFrame, key: Sequence[str], numeric: Sequence[str], categorical: Sequence[str], how: str = "grid",
    families: Sequence[str] | None = None, n: int = 20, cv: int = 5, seed: int = DEFAULT_SEED, at_once: int = 4,
) -> list[Trial]:
    """Trials of the named families (all by default); ``train`` holds 'label', the key and the feature columns."""
    wanted = {name: chosen_points(FAMILIES[name], how, n, seed) for name in (families or FAMILIES)}
    return cross_validate(train.sparkSession, wanted, prepared_folds(train, key, numeric, categorical, cv, seed), at_once)


def best_trials(trials: Sequence[Trial]) -> dict[str, Trial]:
    """The best point of each family; the first one tried among equals."""
    out: dict[str, Trial] = {}
    for t in trials:
        if t.family not in out or t.mean_score > out[t.family].mean_score:
            out[t.family] = t
    return out


def refit(trial: Trial, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    """The trial's model on all training rows, preparation included."""
    shared_folder(train.sparkSession)
    return build_model(FAMILIES[trial.family].classifier(trial.settings), numeric, categorical).fit(train)


def trials_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    """(``family``, ``settings``, ``fold_scores``, ``mean_auc``, ``family_rank``, ``rank``): a line a trial."""
    rows = [(t.family, {k: str(v) for k, v in t.settings.items()}, [float(s) for s in t.fold_scores], float(t.mean_score), i)
            for i, t in enumerate(trials)]
    table = spark.createDataFrame(rows, "family string, settings map<string,string>, fold_scores array<double>, mean_auc double, _n int")
    best = [F.col("mean_auc").desc(), "_n"]
    # A line a trial: tens of rows.
    return table.withColumn("family_rank", F.row_number().over(W.partitionBy("family").orderBy(*best))).withColumn(
        "rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*best))).drop("_n")
