"""Preparation, split, training, tuning, scoring and metrics."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.catalog.registry import query, table
from tabulon.ml import (
    InverseStrengthLogisticRegression, TabularPreparer, build_model, load_model, save_model, score,
    search, trials_table,
)
from tabulon.ml.evaluate import metrics_table
from tabulon.operators import metrics as M
from tabulon.operators.ordering import head
from tabulon.operators.quality import class_rate
from tabulon.operators.split import stratified_folds, stratified_split
from tabulon.session import scratch_path
from tabulon.sources.writers import write_layer

_NUMERIC, _CATEGORICAL, _SCALED = ["n_chars", "toxic"], ["lang", "source"], ["l_extendedprice", "l_discount", "l_tax"]


def graded(spark, folder):
    """Documents with a known quality: the rows to learn from."""
    return (
        table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
        .join(table(spark, folder, "labels"), "doc_id")
        .withColumn("label", F.col("quality").cast("double"))
    )


def graded_split(spark, folder):
    # Stored once: trainers pass over these rows many times.
    parts = write_layer(
        stratified_split(graded(spark, folder), "quality", ["doc_id"]), scratch_path(spark, "graded")
    )
    return parts.filter("split = 'train'"), parts.filter("split = 'test'")


_FILL_SQL = """
WITH g AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END AS l_extendedprice,
             nullif(l_discount, 0.0) AS l_discount, l_tax FROM lineitem),
m AS (SELECT median(l_extendedprice) AS m0, median(l_discount) AS m1, median(l_tax) AS m2 FROM g),
f AS (SELECT l_orderkey, l_linenumber, coalesce(l_extendedprice, m0) AS x0, coalesce(l_discount, m1) AS x1,
        coalesce(l_tax, m2) AS x2 FROM g, m),
s AS (SELECT avg(x0) AS a0, stddev_pop(x0) AS s0, avg(x1) AS a1, stddev_pop(x1) AS s1, avg(x2) AS a2,
        stddev_pop(x2) AS s2 FROM f)
SELECT l_orderkey, l_linenumber, round((x0 - a0) / s0, 4) AS l_extendedprice, round((x1 - a1) / s1, 4) AS l_discount,
  round((x2 - a2) / s2, 4) AS l_tax FROM f, s"""


@query(_FILL_SQL)
def impute_scale(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linestatus") != "O", F.col("l_extendedprice")).alias("l_extendedprice"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"), "l_tax",
    )
    model = TabularPreparer(_SCALED).fit(lines)
    v = vector_to_array("features")
    return model.transform(lines).select(
        "l_orderkey", "l_linenumber", *[F.round(v[i], 4).alias(c) for i, c in enumerate(_SCALED)]
    )


@query("""
WITH g AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p, o_orderstatus AS s FROM orders),
m AS (SELECT p AS common FROM g WHERE p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1),
f AS (SELECT o_orderkey, coalesce(p, common) AS p, s FROM g, m)
SELECT o_orderkey, (p = '1-URGENT')::DOUBLE AS urgent, (p = '2-HIGH')::DOUBLE AS high, (p = '3-MEDIUM')::DOUBLE AS medium,
  (p = '4-NOT SPECIFIED')::DOUBLE AS unspecified, (s = 'F')::DOUBLE AS f, (s = 'O')::DOUBLE AS o FROM f""")
def impute_onehot(spark, folder):
    """Fitted without status 'P', so those rows show the all-zero code of an unknown category."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"), "o_orderstatus"
    )
    columns = ["priority", "o_orderstatus"]
    known = orders.withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    model = TabularPreparer((), columns).fit(known)
    v = vector_to_array("features")
    names = ["urgent", "high", "medium", "unspecified", "f", "o"]
    return model.transform(orders).select("o_orderkey", *[v[i].alias(c) for i, c in enumerate(names)])


_SPLIT_SQL = """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
q AS (SELECT quality, n, ceil((SELECT sum(n) FROM c) * 0.2::DOUBLE) AS wanted,
        n * ceil((SELECT sum(n) FROM c) * 0.2::DOUBLE) / (SELECT sum(n) FROM c) AS share FROM c),
b AS (SELECT *, floor(share) AS base, row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, quality) AS r,
        wanted - sum(floor(share)) OVER () AS spare FROM q),
z AS (SELECT quality, base + CASE WHEN r <= spare THEN 1 ELSE 0 END AS quota FROM b),
o AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR))) AS r
      FROM labels),
parts AS (SELECT doc_id, o.quality, CASE WHEN r <= quota THEN 'test' ELSE 'train' END AS split
          FROM o JOIN z ON o.quality = z.quality)"""


@query(_SPLIT_SQL + " SELECT * FROM parts")
def split_rows(spark, folder):
    return stratified_split(table(spark, folder, "labels"), "quality", ["doc_id"]).select("doc_id", "quality", "split")


@query(_SPLIT_SQL + " SELECT split, count(*) AS n, round(avg(quality), 6) AS rate FROM parts GROUP BY split")
def split_rates(spark, folder):
    parts = stratified_split(table(spark, folder, "labels"), "quality", ["doc_id"])
    return class_rate(parts, "split", "quality").withColumn("rate", F.round("rate", 6))


@query("""
SELECT doc_id, CAST(CASE WHEN r <= ceil(n / 5) THEN 0 WHEN r <= ceil(2 * n / 5) THEN 1 WHEN r <= ceil(3 * n / 5) THEN 2
                         WHEN r <= ceil(4 * n / 5) THEN 3 ELSE 4 END AS INTEGER) AS fold
FROM (SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR))) AS r,
             count(*) OVER (PARTITION BY quality)::DOUBLE AS n FROM labels)""")
def cv_folds(spark, folder):
    return stratified_folds(table(spark, folder, "labels"), "quality", ["doc_id"]).select("doc_id", "fold")


_SCORED_SQL = """
WITH s AS (SELECT quality AS label, round(n_chars / (n_chars + 1500.0), 3) AS score FROM labels JOIN documents USING (doc_id)),
p AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM s)"""


def _scored(spark, folder):
    x = F.col("n_chars")
    rows = table(spark, folder, "documents").select("doc_id", "n_chars").join(table(spark, folder, "labels"), "doc_id")
    return rows.select(F.col("quality").alias("label"), F.round(x / (x + 1500.0), 3).alias("score")).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int")
    )


@query(_SCORED_SQL + """
SELECT CAST(l AS INTEGER) AS label, CAST(q AS INTEGER) AS prediction,
  (SELECT count(*) FROM p WHERE label = l AND prediction = q) AS n
FROM (VALUES (0), (1)) a(l), (VALUES (0), (1)) b(q)""")
def confusion(spark, folder):
    return M.confusion(_scored(spark, folder))


_METRICS_SQL = _SCORED_SQL + """,
t AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
        count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) AS n,
        count(*) FILTER (label = prediction) AS hit FROM p),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM p),
a AS (SELECT (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
        / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc FROM r)"""


@query(_METRICS_SQL + """
SELECT round(hit / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
  round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1, round(auc, 6) AS roc_auc FROM t, a""")
def binary_metrics(spark, folder):
    m = M.evaluate(_scored(spark, folder))
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query(_METRICS_SQL + "SELECT round(auc, 6) AS roc_auc FROM a")
def roc_auc(spark, folder):
    return M.roc_auc(_scored(spark, folder)).select(F.round("roc_auc", 6).alias("roc_auc"))


_VECTORS_SQL = _SPLIT_SQL + """,
doc AS (SELECT doc_id, split, n_chars::DOUBLE AS n_chars, toxic::DOUBLE AS toxic, lang, source FROM documents JOIN labels USING (doc_id) JOIN parts USING (doc_id)),
train AS (SELECT * FROM doc WHERE split = 'train'),
fill AS (SELECT median(n_chars) AS m0, median(toxic) AS m1,
  (SELECT lang FROM train WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS m2,
  (SELECT source FROM train WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1) AS m3 FROM train),
filled AS (SELECT doc_id, split, coalesce(n_chars, m0) AS x0, coalesce(toxic, m1) AS x1, coalesce(lang, m2) AS c0, coalesce(source, m3) AS c1 FROM doc, fill),
scale AS (SELECT avg(x0) AS a0, stddev_pop(x0) AS s0, avg(x1) AS a1, stddev_pop(x1) AS s1 FROM filled WHERE split = 'train'),
known AS (
  SELECT 0 AS g, c0 AS c, row_number() OVER (ORDER BY c0) AS k FROM (SELECT DISTINCT c0 FROM filled WHERE split = 'train')
  UNION ALL SELECT 1, c1, row_number() OVER (ORDER BY c1) FROM (SELECT DISTINCT c1 FROM filled WHERE split = 'train')),
place AS (SELECT g, c, 1 + k + CASE WHEN g = 1 THEN (SELECT count(*) FROM known WHERE g = 0) ELSE 0 END AS i FROM known)
SELECT doc_id, 0::INTEGER AS i, round((x0 - a0) / CASE WHEN s0 = 0 THEN 1 ELSE s0 END, 6) + 0.0 AS value FROM filled, scale WHERE split = 'test'
UNION ALL SELECT doc_id, 1, round((x1 - a1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) + 0.0 FROM filled, scale WHERE split = 'test'
UNION ALL SELECT doc_id, i::INTEGER, (c = CASE WHEN g = 0 THEN c0 ELSE c1 END)::INTEGER::DOUBLE FROM filled, place WHERE split = 'test'"""


@query(_VECTORS_SQL)
def feature_vectors(spark, folder):
    """Held-out rows prepared by what the training rows say, a line a place of the vector."""
    train, test = graded_split(spark, folder)
    model = TabularPreparer(_NUMERIC, _CATEGORICAL).fit(train)
    return model.transform(test).select("doc_id", F.posexplode(vector_to_array("features")).alias("i", "value")).withColumn(
        "value", F.round("value", 6) + 0.0)


_TRAINED_SQL = _SPLIT_SQL + """
SELECT metric, TRUE AS in_range, (SELECT count(*) FROM parts WHERE split = 'test') AS test_rows, TRUE AS same_after_reload
FROM (VALUES ('accuracy'), ('precision'), ('recall'), ('f1'), ('roc_auc')) AS t(metric)"""


def _trained(spark, folder, classifier):
    """Train, save, load: a line a metric says that it is a share, and the same for the model that was loaded."""
    train, test = graded_split(spark, folder)
    model = build_model(classifier, _NUMERIC, _CATEGORICAL).fit(train)
    loaded = load_model(save_model(model, scratch_path(spark, "model")))
    first, again = (metrics_table(m, test).unpivot([], ["accuracy", "precision", "recall", "f1", "roc_auc"], "metric", v)
                    for m, v in ((model, "value"), (loaded, "again")))
    rows = test.agg(F.count(F.lit(1)).alias("n")).scalar()
    return first.join(again, "metric").select(
        "metric", F.col("value").between(0, 1).alias("in_range"), rows.alias("test_rows"),
        (F.abs(F.col("value") - F.col("again")) < 1e-12).alias("same_after_reload"))


@query(_TRAINED_SQL)
def train_gbt(spark, folder):
    return _trained(spark, folder, None)


@query(_TRAINED_SQL)
def train_lr(spark, folder):
    return _trained(spark, folder, InverseStrengthLogisticRegression(C=0.1))


@query(_TRAINED_SQL)
def train_rf(spark, folder):
    return _trained(spark, folder, RandomForestClassifier(numTrees=100, maxDepth=5, minInstancesPerNode=2, seed=42))


@query("""
SELECT * FROM (VALUES ('logistic_regression', 2, 5, TRUE, TRUE, TRUE), ('random_forest', 2, 5, TRUE, TRUE, TRUE),
                      ('gradient_boosting', 2, 5, TRUE, TRUE, TRUE)) AS t(family, trials, folds, in_range, ranked, better_than_chance)""")
def tune_models(spark, folder):
    """A seeded sample of each family's grid over five folds; a line a family says whether its trials are sound."""
    train, _ = graded_split(spark, folder)
    trials = trials_table(spark, search(train.drop("split"), ["doc_id"], _NUMERIC, _CATEGORICAL, "random", n=2, cv=5, at_once=8))
    checked = trials.withColumns({
        "_fair": F.forall("fold_scores", lambda x: (x >= 0) & (x <= 1)),
        "_next": F.lead("mean_auc").over(W.partitionBy("family").orderBy("family_rank"))})
    return checked.groupBy("family").agg(
        F.count(F.lit(1)).cast("int").alias("trials"), F.min(F.size("fold_scores")).alias("folds"), F.every("_fair").alias("in_range"),
        F.every(F.coalesce(F.col("mean_auc") >= F.col("_next"), F.lit(True))).alias("ranked"),
        (F.max("mean_auc") > 0.5).alias("better_than_chance"))


@query("SELECT doc_id, TRUE AS a_share, TRUE AS decided_at_half, TRUE AS same_after_reload FROM documents")
def batch_score(spark, folder):
    """Fit, save, load, score every document with both models and hold the scores against each other."""
    train, _ = graded_split(spark, folder)
    model = build_model(InverseStrengthLogisticRegression(), _NUMERIC, _CATEGORICAL).fit(train)
    loaded = load_model(save_model(model, scratch_path(spark, "model")))
    everything = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    rows = everything.select("doc_id", *_NUMERIC, *_CATEGORICAL)
    first = score(model, rows).select("doc_id", F.col("score_probability").alias("_p"))
    p = F.col("score_probability")
    return score(loaded, rows).join(first, "doc_id").select(
        "doc_id", p.between(0, 1).alias("a_share"), (F.col("score_predicted") == (p >= 0.5)).alias("decided_at_half"),
        (F.abs(p - F.col("_p")) < 1e-12).alias("same_after_reload"))


@query(_SPLIT_SQL + """
SELECT doc_id FROM parts WHERE split = 'test' ORDER BY doc_id LIMIT 20""")
def gold_sample(spark, folder):
    _, test = graded_split(spark, folder)
    return head(test.select("doc_id"), 20, "doc_id")
