"""Layered customer jobs: raw copy, cleaned rows, trained model with its metrics.

Every layer is a table in whole versions: the next one reads all of a version or nothing of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.functions.text import map_labels
from tabulon.ml.evaluate import metrics_table
from tabulon.ml.models import build_model
from tabulon.ml.score import save_model
from tabulon.operators.clean import clean_customers
from tabulon.operators.ordering import head
from tabulon.operators.split import hash_order, stratified_split
from tabulon.schemas import CHURN, CHURN_CATEGORICAL, CHURN_FEATURES, CHURN_NUMERIC, CHURN_TARGET
from tabulon.session import scratch_path, shared_folder
from tabulon.sources.file_order import place_in_files
from tabulon.sources.versions import commit_folder, commit_version, current_version, new_folder, read_version
from tabulon.sources.writers import write_layer, write_metrics

#: Target labels, held-out share, size of the stored sample.
LABELS = {"Yes": 1, "No": 0}
TEST_SIZE, SAMPLE_ROWS = 0.2, 20
ROW_KEY, LOAD_ORDER = "row_key", "load_order"


def to_bronze(spark: SparkSession, source: str, bronze: str) -> DataFrame:
    """Raw copy of the source, every cell as delivered, plus its place in the file."""
    cells = spark.read.csv(source, header=True, escape='"')
    commit_version(cells.select("*", place_in_files().alias(LOAD_ORDER)), bronze, {"source": source})
    return read_version(spark, bronze)


def to_silver(spark: SparkSession, bronze: str, silver: str) -> DataFrame:
    """Extraction and filtering of the raw copy; the first row in the file wins.

    Cells are typed by the declared schema; absent columns are reported by name.
    """
    entry = current_version(spark, bronze)
    raw = read_version(spark, bronze, entry["version"] if entry else None)
    types = {f.name: f.dataType for f in CHURN}
    typed = raw.select(*[
        F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in raw.columns
    ])
    commit_version(clean_customers(typed, [F.col(LOAD_ORDER)]), silver, {"bronze": str(entry["version"])})
    return read_version(spark, silver)


def labelled(clean: DataFrame, features: Sequence[str] = CHURN_FEATURES, target: str = CHURN_TARGET) -> DataFrame:
    """Features, 0/1 ``label`` and a row key, checkpointed.

    The key is the row's content plus a running number among equal rows, so it
    doesn't depend on how the rows are stored.
    """
    rows = clean.select(*features, map_labels(F.col(target), LABELS).alias("label"))
    content = F.sha2(F.to_json(F.struct(*features, "label")), 256)
    copy = F.row_number().over(W.partitionBy("_content").orderBy("_content"))
    shared_folder(clean.sparkSession)
    keyed = rows.withColumn("_content", content)
    return keyed.withColumn(ROW_KEY, F.concat_ws("#", "_content", copy.cast("string"))).drop("_content").checkpoint()


def split_dataset(
    data: DataFrame, test_size: float = TEST_SIZE, seed: int = 42, key: Sequence[str] = (ROW_KEY,), label: str = "label"
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exact class quotas."""
    parts = stratified_split(data, label, key, test_size, seed)
    return parts.filter("split = 'train'").drop("split"), parts.filter("split = 'test'").drop("split")


def to_gold(
    spark: SparkSession, silver: str, gold: str, classifier: Estimator | None = None,
    numeric: Sequence[str] = CHURN_NUMERIC, categorical: Sequence[str] = CHURN_CATEGORICAL,
) -> tuple[PipelineModel, DataFrame]:
    """Split, fit, evaluate; store model, metrics and a sample of test features as one version of the layer.

    The split is written before training: every pass of the trainer then reads the
    same rows even after executors are lost. Nothing shows until all parts are stored.
    """
    entry = current_version(spark, silver)
    data = labelled(read_version(spark, silver, entry["version"] if entry else None), [*numeric, *categorical])
    stored = write_layer(stratified_split(data, "label", [ROW_KEY], TEST_SIZE), scratch_path(spark, "split"))
    train, test = stored.filter("split = 'train'"), stored.filter("split = 'test'")
    model = build_model(classifier, numeric, categorical).fit(train)
    folder = new_folder(gold)
    save_model(model, f"{folder}/model")
    metrics = write_layer(metrics_table(model, test), f"{folder}/metrics_table")
    write_metrics(metrics, f"{folder}/metrics")
    sample = head(test.withColumn("_o", hash_order([ROW_KEY], 42)), SAMPLE_ROWS, "_o")
    kept = write_layer(sample.select(*numeric, *categorical), f"{folder}/test_sample")
    commit_folder(spark, gold, folder, kept.count(), {"silver": str(entry["version"])})
    return model, metrics


def gold_folder(spark: SparkSession, gold: str, version: int | None = None) -> str:
    """Where the parts (``model``, ``metrics``, ``metrics_table``, ``test_sample``) of a gold version lie."""
    entry = current_version(spark, gold, version)
    if entry is None:
        raise LookupError(f"{gold} has no version")
    return f"{gold}/{entry['folder']}"
