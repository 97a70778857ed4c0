"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import (decontaminate, langid, minhash, mixing, packing, prefixes, repair, secrets, sharding, substring, tokens, topk, twins,
                         vptree)
from tabulon.llm.common import n_words, read_table, stage


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies; callers may name any other path."""
    from public_tokenizers import path

    return str(path(name))


def op1(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 7 by the law of rows; null texts have size 1 and no CRC of bytes but that of none."""
    docs = read_table(spark, folder, "documents")
    sized = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return sharding.shard_rows(sized, 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's near-duplicate class (its smallest doc_id) and the class's size; a wordless one is alone."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = stage(minhash.near_duplicates(docs), "near-classes")
    classes = found.filter("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return found.join(classes, "class", "left").select(
        "doc_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.fit_languages(docs.filter(~held_out(F.col("doc_id"))))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "lang_shares")


def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found, _ = secrets.scan_history(docs)

    def many(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    spans = F.array_join(F.transform("findings", lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
    return found.select("doc_id", many("assign").alias("n_assign"), many("access").alias("n_access"),
                        many("hex").alias("n_hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mixing.mix_sources(sizes).select("doc_id", "size", "source_size", "target", "taken")


def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"))


def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, tokenizer("piece_bpe_32k.model")).select("doc_id", "n_tokens")


def op9(spark: SparkSession, folder: str) -> DataFrame:
    return topk.exact_top_k(read_table(spark, folder, "embeddings"))


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return vptree.nearest(read_table(spark, folder, "embeddings"))


def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of all conversations, each beginning with turns of the first of its hundred."""
    turns = stage(prefixes.numbered_turns(read_table(spark, folder, "conversations")), "turns-numbered")
    return prefixes.prefix_trie(prefixes.branched(turns))


def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, read_table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_digest(read_table(spark, folder, "conversations"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_feistel_shards": op1,
    "op2_bag_minhash": op2,
    "op3_super_kmers": op3,
    "op4_language_mixtures": op4,
    "op5_blob_ledger": op5,
    "op6_block_mix": op6,
    "op7_nnls_packing": op7,
    "op8_viterbi_counts": op8,
    "op9_tiled_top_k": op9,
    "op10_vantage_trees": op10,
    "op11_prefix_rollup": op11,
    "op12_word_automaton": op12,
    "op13_run_length_repair": op13,
    "pipeline": pipeline,
}

# Window counting and removal of covered words on exploded windows.
_OP3 = r"""
WITH rows AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT rid, i, md5(array_to_string(words[i:i + 34], ' ')) AS h
  FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 34)) AS i FROM rows)),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT DISTINCT rid, unnest(generate_series(i, i + 34)) AS j FROM again),
word AS (SELECT rid, j, words[j] AS w FROM (SELECT rid, words, unnest(generate_series(1, len(words))) AS j FROM rows)),
kept AS (
  SELECT rid, count(*) AS n, string_agg(w, ' ' ORDER BY j) AS text
  FROM word ANTI JOIN gone USING (rid, j) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM rows LEFT JOIN kept USING (rid)
"""


def _spans_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Spans by the lengths of the gaps and matches; parts alternate gap, match, gap."""
    pattern = pattern.replace("'", "''")
    return f"""
SELECT rid, {rank} AS rank, '{kind}' AS kind, (ends - len(m))::BIGINT AS s, ends::BIGINT AS e FROM (
  SELECT rid, m, g, sum(len(gap) + len(m)) OVER (PARTITION BY rid ORDER BY k) AS ends FROM (
    SELECT rid, unnest(all_m) AS m, unnest(all_g) AS g, unnest(gaps[1:len(all_m)]) AS gap,
           unnest(generate_series(1, len(all_m))) AS k
    FROM (SELECT rid, regexp_extract_all(text, '{pattern}') AS all_m, regexp_extract_all(text, '{pattern}', {group}) AS all_g,
                 string_split_regex(text, '{pattern}') AS gaps FROM rows)))
WHERE len(g) >= {least}"""


_OP5 = (
    "WITH rows AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),\nfound AS ("
    + "\nUNION ALL".join(_spans_sql(r.kind, n, r.pattern, r.group, r.least) for n, r in enumerate(secrets.RULES))
    + """),
per AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b, count(*) FILTER (kind = 'hex') AS c,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM found GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows LEFT JOIN per USING (rid)
"""
)

_OP9 = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

SQL: dict[str, str] = {
    "op3_super_kmers": _OP3, "op5_blob_ledger": _OP5, "op9_tiled_top_k": _OP9, "op11_prefix_rollup": twins.TRIE,
    "op12_word_automaton": twins.LEAKS, "op13_run_length_repair": twins.REPAIR,
}
