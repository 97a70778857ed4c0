"""A corpus pipeline: language, near-duplicates, secrets, mixture and packing, each stage on what the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.llm import langid, minhash, mixing, packing, secrets
from tabulon.llm.catalog import tokenizer
from tabulon.llm.common import WORD, n_words, read_table, stage


def _whole(docs: DataFrame) -> DataFrame:
    """Rows as one struct beside their text, so that no column's name can clash."""
    return docs.select(F.struct("*").alias("_doc"), "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: a null text, one without a letter, or one in a language that no label taught.

    The last are those of whose words under half reach the floor of a learned language. Null langs teach
    nothing; if all are null, only texts without a letter go.
    """
    model = langid.fit_languages(docs.select("doc_id", "text", "lang"))
    if not model.languages:
        return docs.filter(F.rlike("text", F.lit(r"\p{L}")))
    # The text travels once beside the other columns, not also inside them: rows pass through Python here.
    rest = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("_doc"), "text")
    found = langid.identify(rest, model, langid.KNOWN_SHARE).filter(F.col("lang_pred") != langid.UNDETERMINED)
    return found.select(*[F.col("text") if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns])


def _content(docs: DataFrame) -> Column:
    return F.unhex(F.md5("text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class stays, that of the smallest doc_id (nulls last); wordless texts all stay."""
    found = stage(minhash.near_duplicates(docs.select("doc_id", "text")), "pipeline-classes").filter("class is not null")
    first = found.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "content")).alias("_k"))
    keep = first.select(F.col("_k.doc_id").alias("_id"), F.col("_k.content").alias("_content"))
    rows = _whole(docs).withColumn("_c", _content(docs))
    worded = F.coalesce(F.rlike("text", F.lit(WORD)), F.lit(False))
    chosen = rows.filter(worded).join(
        keep, (F.col("_c") == F.col("_content")) & F.col("_doc.doc_id").eqNullSafe(F.col("_id")), "left_semi")
    # Rows that share id and text differ in other columns at most: the first of them stays.
    others = [F.col("_doc")[c] for c in docs.columns if c != "text"]
    order = W.partitionBy("_c", "_doc.doc_id").orderBy(*others)
    chosen = chosen.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("_doc.*")
    return chosen.unionByName(rows.filter(~worded).select("_doc.*"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are cut out of the texts and replaced by a mark; ``n_chars`` follows."""
    found, _ = secrets.scan_history(_whole(docs))
    text = secrets.masked(F.col("text"), F.col("findings"))
    hit = F.size("findings") > 0

    def column(name: str) -> Column:
        if name == "text":
            return text.alias("text")
        own = F.col("_doc")[name]
        return F.when(hit, F.length(text).cast("long")).otherwise(own).alias(name) if name == "n_chars" else own.alias(name)

    return found.select(*[column(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document in whole copies, so that every source has the words the mix takes of it; wordless texts stay once."""
    key = F.struct(*[(_content(docs) if c == "text" else F.col(c)).alias(f"c{n}") for n, c in enumerate(docs.columns)])
    rows = _whole(docs).withColumn("_key", F.struct(*[
        (F.unhex(F.md5("text")) if c == "text" else F.col("_doc")[c]).alias(f"c{n}") for n, c in enumerate(docs.columns)]))
    sizes = docs.select(key.alias("doc_id"), "source", n_words(F.col("text")).alias("size"))
    copies = mixing.whole_copies(mixing.mix_sources(sizes)).filter("copies > 0").withColumnRenamed("doc_id", "_mixed")
    worded = F.coalesce(F.rlike("text", F.lit(WORD)), F.lit(False))
    # Copies are those of all rows that are equal, so one of these stands for them.
    joined = rows.filter(worded).dropDuplicates(["_key"]).join(copies, F.col("_key") == F.col("_mixed"))
    mixed = joined.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_doc.*")
    return mixed.unionByName(rows.filter(~worded).select("_doc.*"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in sequences of at most 2,048 ids."""
    return packing.pack_documents(docs.select("doc_id", "text"), tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixture", mixture),
    ("pack", pack),
]

# Expectation-maximisation, signatures and the tokenizer can't be put in SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
