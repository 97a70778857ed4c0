"""Near-duplicates by BagMinHash signatures of word shingles, banding and verified multiset overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabulon.llm.common import Words, chunks, mix, run_hashes, stage, stage_twice, star_forest

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS_PER_BAND = 32, 5
_BASE = 0x2545F4914F6CDD1D
_UNIT = np.float64(2.0**-53)


class Bags:
    """The shingle bag of each text: distinct shingles with their multiplicity, ordered by text.

    A text of one to four words is a bag of one shingle, all its words; a text
    without words is an empty bag.
    """

    def __init__(self, texts: pa.Array, n: int = SHINGLE_WORDS):
        words = Words(texts)
        per = words.per_doc()
        hashes = words.hashes()
        runs = run_hashes(hashes, n, _BASE)
        at = np.flatnonzero(words.doc[:len(runs)] == words.doc[n - 1:]) if len(runs) else np.zeros(0, np.int64)
        doc, value = words.doc[at], runs[at]
        first = np.cumsum(per) - per
        for short in np.flatnonzero((per > 0) & (per < n)):
            own = hashes[first[short]:first[short] + per[short]]
            doc = np.append(doc, short)
            value = np.append(value, run_hashes(own, len(own), _BASE + 2 * len(own)))
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        head = np.ones(len(doc), dtype=bool)
        head[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        starts = np.flatnonzero(head)
        self.rows = words.rows
        self.doc, self.value = doc[starts], value[starts]
        self.times = np.diff(np.append(starts, len(doc)))
        self.size = np.bincount(doc, minlength=words.rows)
        # Occurrence k of a shingle as a value of its own: bag overlap is then set overlap.
        occurrence = np.arange(len(doc)) - np.repeat(starts, self.times)
        self.all_doc, self.tagged = doc, mix(value + occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def keys(self) -> list[bytes | None]:
        """16 bytes that name each bag whatever its order; nothing for an empty one."""
        total = []
        for salt in (0x632BE59BD9B4E019, 0xD1342543DE82EF95):
            out = np.zeros(self.rows, dtype=np.uint64)
            np.add.at(out, self.all_doc, mix(self.tagged ^ np.uint64(salt)))
            total.append(mix(out + self.size.astype(np.uint64)))
        pairs = np.stack(total, axis=1)
        return [p.tobytes() if n else None for p, n in zip(pairs, self.size)]


def signatures(bags: Bags, registers: int) -> np.ndarray:
    """BagMinHash signatures (rows x registers): two agree in a register with probability sum(min) / sum(max).

    Every shingle owns Poisson processes in time, one for each dyadic interval
    of weights [0, 1), [1, 2), [2, 4) ... that its multiplicity reaches, with a
    rate in proportion to the interval. A point has a register and, further down
    the hierarchy, the unit weight of the interval that it belongs to; it counts
    for bags whose multiplicity is above that weight. So two bags share exactly
    the points below the smaller multiplicity. A register keeps its earliest
    point. Points come in the order of time and a process stops once it is later
    than every register of its bag, so the work follows the bag's distinct
    shingles and registers, not their product.
    """
    levels = np.where(bags.times > 1, np.ceil(np.log2(np.maximum(bags.times, 1))).astype(np.int64), 0) + 1
    item = np.repeat(np.arange(len(bags.value)), levels)
    level = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.where(level > 0, low, 1)
    times, doc = bags.times[item], bags.doc[item]
    seed = mix(bags.value[item] ^ mix(level.astype(np.uint64) + np.uint64(0xA0761D6478BD642F)))
    earliest = np.full(bags.rows * registers, np.inf)
    clock = np.zeros(len(item))
    step = 0
    live = np.arange(len(item))
    while len(live):
        step += 0x9E3779B97F4A7C15
        draw = mix(seed[live] + np.uint64(step % 2**64))
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT)
        clock[live] += gap / (width[live] * registers)
        other = mix(draw ^ np.uint64(0xE7037ED1A0B428DB))
        register = ((other >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        unit = low[live] + ((other & np.uint64(0xFFFFFFFF)) * width[live].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        counts = unit < times[live]
        np.minimum.at(earliest, doc[live[counts]] * registers + register[counts], clock[live[counts]])
        own = doc[live]
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        latest = earliest.reshape(bags.rows, registers)[own[heads]].max(axis=1)
        live = live[clock[live] <= np.repeat(latest, np.diff(np.append(heads, len(own))))]
    return earliest.reshape(bags.rows, registers)


def sign_documents(docs: DataFrame, bands: int = BANDS, rows_per_band: int = ROWS_PER_BAND) -> DataFrame:
    """(``doc_id``, ``content``, ``bag``, ``buckets``) of each row: the text's MD5, its bag's key and its bucket in each band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            bags = Bags(part["text"])
            marks = np.ascontiguousarray(signatures(bags, bands * rows_per_band)).view(np.uint64)
            joined = marks.reshape(bags.rows, bands, rows_per_band)
            bucket = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (bags.rows, bands)).copy()
            for r in range(rows_per_band):
                bucket = mix(bucket * np.uint64(_BASE) + joined[:, :, r])
            buckets = pa.ListArray.from_arrays(
                pa.array(np.arange(bags.rows + 1) * bands, pa.int32()), pa.array(bucket.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["content"], pa.array(bags.keys(), pa.binary()), buckets],
                names=["doc_id", "content", "bag", "buckets"])

    rows = docs.select("doc_id", F.unhex(F.md5("text")).alias("content"), "text")
    return rows.mapInArrow(run, "doc_id long, content binary, bag binary, buckets array<long>")


def bag_shingles(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(``bag``, ``shingles``) of the wanted (``bag``, ``content``) rows, one text for each bag."""
    texts = docs.filter("text is not null").withColumn("content", F.unhex(F.md5("text"))).select("content", "text")
    texts = texts.join(wanted, "content").dropDuplicates(["bag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            bags = Bags(part["text"])
            ends = np.concatenate([[0], np.cumsum(bags.size)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bags.tagged.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part["bag"], lists], names=["bag", "shingles"])

    return texts.select("bag", "text").mapInArrow(run, "bag binary, shingles array<long>")


def verified(pairs: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose bags overlap by ``similarity`` or more: sum(min) / sum(max)."""
    left = shingles.select(F.col("bag").alias("a"), F.col("shingles").alias("_a"))
    right = shingles.select(F.col("bag").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_a", "_b"))
    return both.withColumn("_s", shared).filter(
        F.col("_s") >= F.lit(similarity) * (F.size("_a") + F.size("_b") - F.col("_s"))).select("a", "b")


def with_bounds(members: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """Members (``bucket``, ``bag``) that can be alike to any other of their bucket, with ``unshared``.

    Shingles that no other candidate has can't be part of any overlap. With n
    shingles, u of them unshared, and others of at least ``low`` shingles, the
    similarity is at most (n - u) / (max(low, n - u) + u). Who stays below is compared with nobody.
    """
    each = shingles.select(F.xxhash64("bag").alias("_h"), F.explode("shingles").alias("_s"))
    single = each.groupBy("_s").agg(F.count("*").alias("_c"), F.min("_h").alias("_h")).filter("_c = 1")
    unshared = single.groupBy("_h").agg(F.count("*").alias("_u"))
    facts = shingles.select("bag", F.xxhash64("bag").alias("_h"), F.size("shingles").alias("_n"))
    facts = facts.withColumn("_twins", F.count("*").over(W.partitionBy("_h"))).join(unshared, "_h", "left")
    facts = facts.select("bag", "_n", F.when(F.col("_twins") == 1, F.coalesce("_u", F.lit(0))).otherwise(0).alias("unshared"))
    known = members.join(facts, "bag")
    low = known.groupBy("bucket").agg(F.min("_n").alias("_low"))
    rest = F.col("_n") - F.col("unshared")
    return known.join(low, "bucket").filter(
        rest >= F.lit(similarity) * (F.greatest("_low", rest) + F.col("unshared"))).select("bucket", "bag", "unshared")


def block_links(members: DataFrame, shingles: DataFrame, similarity: float, block_rows: int = 1024) -> DataFrame:
    """Links (``a``, ``b``) between members (``bucket``, ``bag``, ``root``) of a bucket that aren't of one component.

    Who is not of a bucket's largest component is compared with the whole
    bucket, block against block; only links leave a block, never its pairs.
    """
    per = members.groupBy("bucket", "root").agg(F.count("*").alias("_c"))
    per = per.groupBy("bucket").agg(F.sum("_c").alias("_all"), F.max("_c").alias("_most"), F.max_by("root", F.struct("_c", "root")).alias("_main"))
    blocks = per.select("bucket", "_main", F.ceil(F.col("_all") / block_rows).cast("int").alias("_nj"),
                        F.ceil((F.col("_all") - F.col("_most")) / block_rows).cast("int").alias("_ni"))
    full = members.join(blocks, "bucket").join(shingles, "bag").withColumn("_h", F.xxhash64("bag"))
    left, right = stage_twice(full, "near-blocks")
    left = left.filter("root <> _main").withColumn("i", F.pmod("_h", "_ni").cast("int"))
    left = left.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("_nj") - 1)))
    right = right.withColumn("j", F.pmod("_h", "_nj").cast("int"))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("_ni") - 1)))
    columns = ["bucket", "i", "j", "bag", "root", "shingles"]

    def flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = table["shingles"].combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            mine, n_mine = flat(left)
            theirs, n_theirs = flat(right)
            vocabulary, code = np.unique(mine, return_inverse=True)
            at = np.minimum(np.searchsorted(vocabulary, theirs), len(vocabulary) - 1)
            at = np.where(vocabulary[at] == theirs, at, len(vocabulary))
            starts, ends = np.cumsum(n_theirs) - n_theirs, np.cumsum(n_mine)
            bags, roots = right["bag"].to_pylist(), np.array(right["root"].to_pylist(), dtype=object)
            for row, (bag, root) in enumerate(zip(left["bag"].to_pylist(), left["root"].to_pylist())):
                has = np.zeros(len(vocabulary) + 1, dtype=np.int32)
                has[code[ends[row] - n_mine[row]:ends[row]]] = 1
                shared = np.add.reduceat(has[at], starts)
                alike = shared >= similarity * (n_mine[row] + n_theirs - shared)
                hits = np.flatnonzero(alike & (roots != root))
                # One link to a component is as good as all of them.
                for k in {roots[h]: h for h in hits[::-1].tolist()}.values():
                    a.append(bag)
                    b.append(bags[k])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    found = left.select(*columns).groupBy("bucket", "i", "j").cogroup(
        right.select(*columns).groupBy("bucket", "i", "j")).applyInArrow(compare, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS,
                    rows_per_band: int = ROWS_PER_BAND, pivots: tuple[int, ...] = (1, 4)) -> DataFrame:
    """Classes of near-duplicates among ``docs`` (``doc_id``, ``text``): (``doc_id``, ``content``, ``class``) per row.

    Rows with the same bag of shingles are one node. Nodes that share a bucket
    are candidates. Nodes whose unshared shingles rule out any link leave first.
    Then, instead of all pairs of a bucket, a few pivots (those with the fewest
    unshared shingles) are compared with the members that aren't in their component
    yet; verified links join components; pivots that have met everyone leave the
    bucket; and a bucket whose members are one component is done. After the
    rounds of ``pivots``, what a bucket still has outside its largest component
    meets the whole bucket in blocks. So two candidates that are not in one class
    have been compared, and no link that could join classes is lost, while a
    group of thousands of copies mostly costs a comparison a member.

    ``class`` is null for rows whose text has no words (or is null): they are
    like no other row. ``content`` is the text's MD5.
    """
    signed = stage(sign_documents(docs, bands, rows_per_band), "near-signed")
    nodes = signed.filter("bag is not null")
    one = nodes.groupBy("bag").agg(F.min("content").alias("content"), F.first("buckets").alias("buckets"))
    rows = one.select("bag", F.explode("buckets").alias("bucket"))
    crowded = rows.groupBy("bucket").agg(F.count("*").alias("_n")).filter("_n > 1").select("bucket")
    members = stage(rows.join(crowded, "bucket"), "near-members")
    wanted = members.select("bag").distinct().join(nodes.groupBy("bag").agg(F.min("content").alias("content")), "bag")
    shingles = stage(bag_shingles(docs, wanted), "near-shingles")
    alone = stage(with_bounds(members, shingles, similarity).withColumn("root", F.col("bag")), "near-members")

    def joined(links: DataFrame, roots: DataFrame | None) -> DataFrame:
        """Components of the new links and of those found before, which the forest holds already."""
        if roots is not None:
            links = links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        return star_forest(links, "near-components")

    roots = None
    for most in pivots:
        rank = F.row_number().over(W.partitionBy("bucket").orderBy("unshared", "bag"))
        chosen = stage(alone.withColumn("_n", rank).filter(F.col("_n") <= most).select("bucket", "bag", "root"), "near-pivots")
        centre = chosen.select("bucket", F.col("bag").alias("_p"), F.col("root").alias("_pr"))
        pairs = alone.join(centre, "bucket").filter("root <> _pr").select(
            F.least("bag", "_p").alias("a"), F.greatest("bag", "_p").alias("b")).distinct()
        roots = joined(stage(verified(pairs, shingles, similarity), "near-links"), roots)
        rest = alone.drop("root").join(chosen.select("bucket", "bag"), ["bucket", "bag"], "left_anti")
        rest = rest.join(roots.withColumnRenamed("node", "bag"), "bag", "left").withColumn("root", F.coalesce("root", "bag"))
        rest = stage(rest, "near-rest")
        split = rest.groupBy("bucket").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).filter("_a <> _b")
        alone = stage(rest.join(split.select("bucket"), "bucket"), "near-members")
    if not alone.isEmpty():
        roots = joined(stage(block_links(alone.select("bucket", "bag", "root"), shingles, similarity), "near-links"), roots)
    found = signed.drop("buckets").join(roots.withColumnRenamed("node", "bag"), "bag", "left")
    return found.select("doc_id", "content", F.coalesce("root", "bag").alias("class"))
