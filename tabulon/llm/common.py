"""Helpers shared by the operators: staging, distributed prefix sums, components and words as arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.session import scratch_path

# Fixed by the contracts: a word is a run of anything but these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"
SEPARATORS = SPACES.decode()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later steps restart from the files, not from the input."""
    return stage_twice(df, name)[0]


def stage_twice(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """One staged table as two scans with columns of their own, as both sides of a cogroup need them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema)
    return read.parquet(path), read.parquet(path)


def n_words(text: Column) -> Column:
    """Words of a text without building them: starts of non-space runs."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Equal rows that travel as one row of a running sum at most.
COPIES = 1_000
#: Shuffle partitions of one running sum at most.
MOST_PARTS = 20_000


def running_start(
    rows: DataFrame, group: list[str], weight: Column, tie: list[str], out: str, buckets: int, copies: int = COPIES,
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the rows of the same group that come before.

    Rows are ordered by a hash of ``tie``, then by ``tie``. The hash also cuts a
    group into ``buckets`` parts, each summed in its own task, so a group that
    holds a third of all rows is spread as evenly as any other; the parts' totals
    (groups x buckets rows) give the offsets. Rows equal in all columns are counted
    before they move and go on as rows for ``copies`` of them at most, each with a
    hash of its own, so a row that comes a billion times is spread too. Rows equal
    in ``tie`` only are taken as interchangeable. Null groups count as one group.
    """
    names = rows.columns
    counted = rows.withColumn("_w", weight.cast("long")).groupBy(*names, "_w").agg(F.count("*").alias("_c"))
    cut = counted.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1, F.lit(copies).cast("long"))))
    keyed = cut.withColumns({
        "_h": F.when(F.col("_from") == 0, F.xxhash64(*tie)).otherwise(F.xxhash64(*tie, "_from")),
        "_n": F.least(F.col("_c") - F.col("_from"), F.lit(copies)),
    }).withColumn("_b", F.pmod("_h", F.lit(buckets)))
    # A stated number of parts: small as the counted rows are, each becomes up to ``copies`` rows of its task.
    keyed = keyed.repartition(min(buckets, MOST_PARTS), *group, "_b")
    keys, whole = [*group, "_b"], F.col("_w") * F.col("_n")
    totals = keyed.groupBy(*keys).agg(F.sum(whole).alias("_t"))
    ahead = W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumn("_o", F.coalesce(F.sum("_t").over(ahead), F.lit(0))).drop("_t")
    before = W.partitionBy(*keys).orderBy("_h", *tie, "_from").rowsBetween(W.unboundedPreceding, -1)
    inside = keyed.withColumn("_i", F.coalesce(F.sum(whole).over(before), F.lit(0)))
    right = offsets.select(*[F.col(k).alias(f"_r{n}") for n, k in enumerate(keys)], "_o")
    same = [inside[k].eqNullSafe(right[f"_r{n}"]) for n, k in enumerate(keys)]
    each = inside.join(right, same).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return each.select(*names, (F.col("_i") + F.col("_o") + F.col("_k") * F.col("_w")).alias(out))


def ordered_sha256(pieces: DataFrame, keys: list[str], order: list[str], piece: str, separator: str, out: str) -> DataFrame:
    """SHA-256 (lowercase hex) of each key's pieces in order, joined by ``separator``: (``keys``, ``out``).

    Pieces are sorted within tasks and stream through a running hash, so a key of any size needs no memory of its
    own; a hash is one sequence, so one key stays in one task. Null pieces are empty.
    """
    sorted_rows = pieces.select(*keys, *order, piece).repartition(*keys).sortWithinPartitions(*keys, *order)
    schema = T.StructType([*pieces.select(*keys).schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        last, digest, done = None, None, []
        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            for row in zip(*[batch[c].to_pylist() for c in [*keys, piece]]):
                key, text = row[:-1], (row[-1] or "").encode()
                if digest is not None and key == last:
                    digest.update(between)
                    digest.update(text)
                else:
                    if digest is not None:
                        done.append((*last, digest.hexdigest()))
                    last, digest = key, hashlib.sha256(text)
            if done:
                yield as_batch(done, types)
                done = []
        if digest is not None:
            yield as_batch([(*last, digest.hexdigest())], types)

    between = separator.encode()

    def as_batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), [*types, pa.string()])], names=[*keys, out])

    return sorted_rows.mapInArrow(run, schema)


def star_forest(links: DataFrame, name: str) -> DataFrame:
    """Each node of ``links`` (a, b) that isn't the smallest of its component, under the smallest: (node, root).

    Large-star and small-star steps in turn; every round's links are written to
    the shared folder, so lineage stays short and a lost executor costs one round.
    Stops when nobody has two parents and no parent is a child, after about
    log(nodes) rounds. ``links`` are read several times: pass a staged table.
    A step deals its links by node once, for the smallest neighbour and for the
    links that move there; a round makes no link twice as long, so only its end
    removes equal ones. Each shuffle costs the driver a task's record a partition.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        """Each link (a, b) with ``m``, the smallest of ``a`` and its neighbours."""
        dealt = edges.repartition("a")
        return dealt.join(dealt.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "a")

    def large_star(edges: DataFrame) -> DataFrame:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        return smallest(both).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(edges: DataFrame) -> DataFrame:
        # Each node with its smaller neighbours only; these and the node itself hang on the smallest.
        found = smallest(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        each = found.select("m", F.explode(F.array("a", "b")).alias("a")).select("a", F.col("m").alias("b"))
        return each.filter(F.col("a") != F.col("b"))

    edges = links.select("a", "b").filter("a <> b")
    while True:
        edges = stage(small_star(large_star(edges)).distinct(), name)
        part = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select("b", F.lit(0), F.lit(1)))
        part = part.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not part.agg(F.max(F.col("up") + F.least("up", "down") > 1)).first()[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


# --- words of an Arrow column as numpy arrays ---------------------------------------------------------------

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def chunks(batches: Iterator[pa.RecordBatch], most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds about ``most`` bytes of ``text``; one longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


class Words:
    """All words of a string column: byte buffer, ``start``/``end`` of each word and its row ``doc``."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data = data = data[offsets[0]:offsets[-1]]
        self.offsets = offsets = offsets - offsets[0]
        ink = ~_IS_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        first, last = ink.copy(), ink.copy()
        if len(data):
            first[1:] &= ~ink[:-1] | edge[1:-1]
            last[:-1] &= ~ink[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.rows = len(texts)

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.rows)

    def hashes(self, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
        """A 64-bit hash of every word: a polynomial over its bytes, finalised with its length."""
        out = np.zeros(len(self.start), np.uint64)
        size = self.end - self.start
        if not len(size):
            return out
        weights = powers(base | 1, int(size.max()))
        ends = np.cumsum(size)
        cuts = [0, *np.unique(np.searchsorted(ends, np.arange(1_000_000, ends[-1], 1_000_000), side="right")).tolist(), len(size)]
        for a, b in zip(cuts, cuts[1:]):  # a bounded number of bytes at a time
            if a == b:
                continue
            n = size[a:b]
            at = np.cumsum(n) - n
            inside = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(at, n)
            value = weights[inside]
            value *= self.data[inside + np.repeat(self.start[a:b], n)].astype(np.uint64) + np.uint64(1)
            out[a:b] = np.add.reduceat(value, at)
        return mix(out + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes (across rows too; callers keep the valid starts)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    count = len(words) - n + 1
    if n <= 8:
        out = words[:count].copy()
        for t in range(1, n):
            out *= np.uint64(base)
            out += words[t:count + t]
        return mix(out)
    inverse = pow(base, -1, 2**64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(base, len(words)), dtype=np.uint64)])
    return mix((total[n:] - total[:count]) * powers(inverse, count))
