"""Mixing sources to target weights: blocks of words drawn by shard and joined by index."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.llm.common import running_start, stage
from tabulon.llm.sharding import permute

BLOCK_WORDS = 256
SLOTS_PER_SHARD = 4096
PART = 1 << 30  # a whole copy, in the units in which parts of copies are summed


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    Sources in code-point order (null last) take the weights in turn and share
    ``share`` of all words; a target stops at ``most`` times its source's words
    and what it can't hold goes to the rest by weight. That is a water level:
    with sources in order of their filling point cap / weight, the first ones
    are full and the rest share what is left by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    per = per.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    per = per.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    filling = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    upto, after = filling.rowsBetween(W.unboundedPreceding, -1), filling.rowsBetween(0, W.unboundedFollowing)
    left = F.sum("source_size").over(W.partitionBy()) * F.lit(share) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))
    per = per.withColumn("_level", left / F.sum("_w").over(after))
    per = per.withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_w"))
    # The level that holds is that of the first source that isn't full.
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("_w"), "_level"))).over(W.partitionBy())["_level"]
    return per.select("source", "source_size",
                      F.when(F.col("_full"), F.col("_cap")).otherwise(level * F.col("_w")).alias("target"))


def _below(u: Column, bounds: list[float]) -> Column:
    """How many bounds are at or below ``u``."""
    return F.aggregate(F.array(*[F.lit(float(x)) for x in bounds]), F.lit(0), lambda n, x: n + (x <= u).cast("int"))


def draw_slots(blocks: DataFrame, seed: int, slots_per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """Deal the output's slots to sources: (``_s``, ``index``), index from 0 to ``full`` - 1 for each source.

    ``blocks`` has per source its number ``_s`` from 0 and ``full``, the slots its
    target asks for. Each shard of the output is a fixed run of slots; each slot
    draws its source with probability full / sum(full), so a shard's counts are
    multinomial. Running totals of the shards' counts index the draws of a
    source. Draws beyond what a source's target asks for go, in order, to the
    sources that came out short, so the totals are those of the targets.
    ``blocks`` has a row per source; it is the only thing read on the driver.
    """
    spark = blocks.sparkSession
    per = {r["_s"]: r["full"] for r in blocks.select("_s", "full").collect()}
    names, total = sorted(per), sum(per.values())
    bounds, at = [], 0
    for s in names:
        at += per[s]
        bounds.append(at / max(total, 1))
    unit = (F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11)) / F.lit(float(2**53))
    slots = spark.range(total).select(
        "id", F.floor(F.col("id") / slots_per_shard).alias("shard"),
        F.least(_below(unit, bounds[:-1]), F.lit(max(len(names) - 1, 0))).alias("_s"),
    )
    counts = slots.groupBy("shard", "_s").agg(F.count("*").alias("_n"))
    ahead = W.partitionBy("_s").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "_s", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"))
    within = F.row_number().over(W.partitionBy("shard", "_s").orderBy("id")) - 1
    drawn = slots.withColumn("_k", within).join(starts, ["shard", "_s"]).select(
        "_s", (F.col("_first") + F.col("_k")).alias("index"))
    quota = F.element_at(F.array(*[F.lit(per[s]).cast("long") for s in names] or [F.lit(0).cast("long")]), F.col("_s") + 1)
    drawn = stage(drawn.withColumn("_over", F.col("index") - quota), "mix-slots")
    got = {r["_s"]: r["n"] for r in drawn.groupBy("_s").agg(F.count("*").alias("n")).collect()}
    # Surplus draw number o of all sources refills short place number o of all sources.
    surplus_at, short_at, refill, o, p = [], [], [], 0, 0
    for s in names:
        surplus_at.append(o)
        o += max(0, got.get(s, 0) - per[s])
        short_at.append(p)
        refill.append(min(got.get(s, 0), per[s]))
        p += max(0, per[s] - got.get(s, 0))
    kept = drawn.filter("_over < 0").select("_s", "index")
    if not o:
        return kept

    def pick(values: list[int], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at + 1)

    moved = drawn.filter("_over >= 0").select((pick(surplus_at, F.col("_s")) + F.col("_over")).alias("_o"))
    moved = moved.withColumn("_s", _below(F.col("_o"), short_at) - 1)
    moved = moved.select("_s", (pick(refill, F.col("_s")) + F.col("_o") - pick(short_at, F.col("_s"))).alias("index"))
    return kept.union(moved)


def mix_sources(sizes: DataFrame, seed: int = 11, block_words: int = BLOCK_WORDS, rows_per_bucket: int = 20_000,
                weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """Mix documents (``doc_id``, ``source``, ``size`` in words) to target weights.

    Adds ``source_size``, ``target`` and ``taken``: how many of the document's
    words the mix takes, repeats counted. Each source's documents, in the order
    of a hash, form one stream of words that is cut in equal blocks of about
    ``block_words`` (within half of it, lengths one word apart at most). Slots
    are dealt to sources shard by shard (``draw_slots``); index i of a source
    reads block permutation(i mod blocks) of epoch i div blocks, so no block is
    used an epoch early, and the words beyond the last full slot are the head of
    the next block. A document's words are in one block each and no target is
    above twice its source, so no document exceeds twice its size.

    Null sources are one source, a null size is 0, repeated rows are separate
    documents, and empty tables give empty results.
    """
    base = stage(sizes.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size")), "mix-sizes")
    targets = stage(source_targets(base, weights, share).withColumn(
        "_s", F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1), "mix-targets")
    n = F.greatest(F.round(F.col("source_size") / block_words), F.lit(1)).cast("long")
    per_block = F.col("source_size") / F.col("n_blocks")
    plan = targets.withColumn("n_blocks", n).withColumn(
        "full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / per_block + F.lit(1e-9))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.when(F.col("source_size") > 0,
                                          F.round(F.col("target") - F.col("full") * per_block)).otherwise(0).cast("long"))
    plan = stage(plan, "mix-plan")
    lookup = plan.select("_s", "n_blocks", "source_size", "full", "rest")

    def block_of(index: Column) -> Column:
        epoch = F.floor(index / F.col("n_blocks"))
        return permute(F.pmod(index, F.col("n_blocks")), F.col("n_blocks"), F.col("_s"), epoch, seed)

    slots = draw_slots(plan, seed).join(lookup, "_s")
    used = slots.select("_s", block_of(F.col("index")).alias("block")).groupBy("_s", "block").agg(F.count("*").alias("uses"))
    heads = lookup.filter("rest > 0").select("_s", block_of(F.col("full")).alias("block"), F.col("rest").alias("head"))
    blocks = used.join(heads, ["_s", "block"], "full_outer").na.fill(0, ["uses", "head"])

    buckets = max(1, math.ceil(base.count() / rows_per_bucket))
    docs = running_start(base, ["source"], F.col("size"), ["doc_id", "size"], "_start", buckets)
    numbers = plan.select(F.col("source").alias("_source"), "_s", "source_size", "target", "n_blocks")
    docs = docs.join(numbers, docs["source"].eqNullSafe(numbers["_source"])).drop("_source")

    def edge(k: Column) -> Column:  # the first word of block k
        return F.floor(F.expr("cast(source_size as decimal(38, 0))") * k / F.col("n_blocks")).cast("long")

    def holding(word: Column) -> Column:  # the block of a word, by the same cut points
        guess = F.floor(word.cast("decimal(38, 0)") * F.col("n_blocks") / F.col("source_size")).cast("long")
        return F.when(edge(guess + 1) <= word, guess + 1).when(edge(guess) > word, guess - 1).otherwise(guess)

    parts = docs.filter("size > 0").withColumn("block", F.explode(F.sequence(
        holding(F.col("_start")), holding(F.col("_start") + F.col("size") - 1))))
    parts = parts.withColumns({"_from": edge(F.col("block")), "_to": edge(F.col("block") + 1)})
    parts = parts.join(blocks, ["_s", "block"])
    low, high = F.greatest("_from", "_start"), F.least(F.col("_to"), F.col("_start") + F.col("size"))
    whole = (high - low) * F.col("uses")
    head = F.greatest(F.lit(0), F.least(high, F.col("_from") + F.col("head")) - low)
    taken = parts.groupBy("_s", "_start", "size").agg(F.sum(whole + head).alias("taken"))
    # Within a source only documents without words share a start, and those have no part.
    return docs.join(taken, ["_s", "_start", "size"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def whole_copies(mixed: DataFrame, seed: int = 11, rows_per_bucket: int = 20_000) -> DataFrame:
    """Whole copies of each document for the words that ``mix_sources`` took: (``doc_id``, ``copies``), a row per doc_id.

    The parts of copies left over are summed along each source's documents, from
    short ones to long ones, from a seeded start; a document gets one copy more
    where the sum passes a whole number. So each is rounded up as often as its
    part says, errors are carried on from one document to the next, and a source
    is off its words by little more than its longest document. The order is that
    of size classes, eight to a doubling, then of a hash. Rows of one
    doc_id have one size and source and share its copies; those without words get none.
    """
    per = mixed.filter("size > 0").groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("taken"))
    per = per.withColumn("_class", F.floor(F.log2("size") * 8).cast("int"))
    per = stage(per.withColumn("_part", F.floor(F.expr("taken % size") / F.col("size") * PART).cast("long")), "mix-parts")
    buckets = max(1, math.ceil(per.count() / rows_per_bucket))
    shorter = W.partitionBy("source").orderBy("_class").rowsBetween(W.unboundedPreceding, -1)
    classes = per.groupBy("source", "_class").agg(F.sum("_part").alias("_t")).select(
        F.col("source").alias("_source"), F.col("_class").alias("_c"), F.coalesce(F.sum("_t").over(shorter), F.lit(0)).alias("_below"))
    rows = running_start(per, ["source", "_class"], F.col("_part"), ["doc_id", "size"], "_ahead", buckets)
    rows = rows.join(classes, rows["source"].eqNullSafe(classes["_source"]) & (rows["_class"] == classes["_c"]))
    at = F.col("_below") + F.col("_ahead") + F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(PART))
    more = F.shiftright(at + F.col("_part"), 30) - F.shiftright(at, 30)
    return rows.select("doc_id", (F.expr("taken div size") + more).cast("int").alias("copies"))
