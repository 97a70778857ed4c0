"""Exact stratified train/test split and cross-validation folds.

Rows of a class are in the order of a seeded hash of their key. A quota is a place in
that order, and the hash at this place is found by refining histograms of its leading
digits; after that, split and folds are comparisons with it. No class is ever sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows under one prefix of the hash that may be sorted in one task.
RANKED_ROWS = 20_000
# Hex digits of the hash, and how many of them one refinement looks at.
_DIGITS, _STEP = 32, 3


def hash_order(key: Sequence[str], seed: int) -> Column:
    """Reproducible pseudo-random order of rows, independent of how they are stored."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def class_quotas(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """Test rows per class: ceil(test_size * n) in all, shared out by largest remainder.

    Ties between remainders go to the smaller class label. Rows without a label have no class and no share.
    """
    known = df.filter(F.col(label).isNotNull())
    classes = known.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("n"))
    # One row per class from here on.
    everything = W.partitionBy(F.lit(0))
    total = F.sum("n").over(everything)
    wanted = F.ceil(total * F.lit(test_size))
    exact = classes.withColumn("wanted", wanted).withColumn("share", F.col("n") * F.col("wanted") / total)
    floored = exact.withColumn("base", F.floor("share")).withColumn("rest", F.col("share") - F.col("base"))
    spare = F.col("wanted") - F.sum("base").over(everything)
    order = W.partitionBy(F.lit(0)).orderBy(F.round("rest", 9).desc(), F.col("_class"))
    return floored.withColumn("spare", spare).select(
        "_class",
        (F.col("base") + F.when(F.row_number().over(order) <= F.col("spare"), 1).otherwise(0)).alias("_quota"),
    )


@dataclass(frozen=True)
class Threshold:
    """The order value at one rank of a class: rows below it come first, and ``take`` of the ``ties`` equal to it."""

    value: str
    take: int
    ties: int


def refined(
    rows: DataFrame, label: str, ranks: Mapping[object, Sequence[int]], ranked_rows: int = RANKED_ROWS,
) -> dict[tuple[object, int], tuple[str, int, int]]:
    """For each (class, number of its rank): the hash prefix that holds it, rows before the prefix, rows under it.

    Each round counts rows by the next digits, under the prefixes that still hold more than ``ranked_rows``; a task
    sends a partial count a prefix, and a line for each rank reaches the driver.
    """
    at: dict[tuple[object, int], tuple[str, int, int]] = {}
    rank = {(c, n): k for c, wanted in ranks.items() for n, k in enumerate(wanted)}
    deep, digits = {t: ("", 0) for t in rank}, 0
    while deep:
        above, digits = digits, min(digits + _STEP, _DIGITS)
        counts = rows.filter(_under(label, {(c, p) for (c, _), (p, _) in deep.items()})).groupBy(
            F.col(label).alias("_class"), F.left("_order", F.lit(digits)).alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
        # At most 4096 lines under one prefix.
        inside = W.partitionBy("_class", F.left("_prefix", F.lit(above))).orderBy("_prefix")
        bins = counts.withColumn("_before", F.sum("_n").over(inside) - F.col("_n"))
        wanted = [(t, p, passed, rank[t] - passed) for t, (p, passed) in deep.items()]
        hits = F.lit(False)
        for (c, _), p, _, rest in wanted:
            hits = hits | ((F.col("_class") == F.lit(c)) & F.startswith("_prefix", F.lit(p)) & _holds(F.col("_before"), F.col("_n"), rest))
        found, deep = bins.filter(hits).collect(), {}
        for t, p, passed, rest in wanted:
            r = next(r for r in found if r["_class"] == t[0] and r["_prefix"].startswith(p) and _holds(r["_before"], r["_n"], rest))
            if r["_n"] > ranked_rows and digits < _DIGITS:
                deep[t] = (r["_prefix"], passed + r["_before"])
            else:
                at[t] = (r["_prefix"], passed + r["_before"], r["_n"])
    return at


def _holds(before, n, rest):
    return (before < rest) & (rest <= before + n)


def rank_thresholds(
    rows: DataFrame, label: str, ranks: Mapping[object, Sequence[int]], ranked_rows: int = RANKED_ROWS,
) -> dict[object, list[Threshold]]:
    """For each class, the value of ``_order`` at each of the given ranks (from 1), which must exist.

    The k-th value is found by :func:`refined` histograms; only the few rows under its last prefix are ever sorted.
    """
    at = refined(rows, label, ranks, ranked_rows)
    out: dict[object, list[Threshold]] = {c: [Threshold("", 0, 0)] * len(wanted) for c, wanted in ranks.items()}
    for size in {len(p) for p, _, _ in at.values()}:
        mine = {t: (p, ranks[t[0]][t[1]] - passed) for t, (p, passed, _) in at.items() if len(p) == size}
        left = rows.filter(_under(label, {(c, p) for (c, _), (p, _) in mine.items()}))
        equal = left.groupBy(F.col(label).alias("_class"), F.left("_order", F.lit(size)).alias("_prefix"), "_order").agg(
            F.count(F.lit(1)).alias("_n"))
        running = F.sum("_n").over(W.partitionBy("_class", "_prefix").orderBy("_order")) - F.col("_n")
        wanted = F.lit(False)
        for (c, _), (p, rest) in mine.items():
            wanted = wanted | ((F.col("_class") == F.lit(c)) & (F.col("_prefix") == F.lit(p)) & _holds(F.col("_before"), F.col("_n"), rest))
        found = equal.withColumn("_before", running).filter(wanted).collect()
        for (c, n), (p, rest) in mine.items():
            r = next(r for r in found if r["_class"] == c and r["_prefix"] == p and _holds(r["_before"], r["_n"], rest))
            out[c][n] = Threshold(r["_order"], rest - r["_before"], r["_n"])
    return out


def _under(label: str, prefixes: set[tuple[object, str]]) -> Column:
    """Rows of a class below one of its prefixes."""
    out = F.lit(False)
    for c, prefix in sorted(prefixes, key=str):
        out = out | ((F.col(label) == F.lit(c)) & F.startswith("_order", F.lit(prefix)))
    return out


def _dealt(rows: DataFrame, label: str, key: Sequence[str], thresholds: Mapping[object, Sequence[Threshold]], name: str) -> DataFrame:
    """Add ``name``: how many of its class's thresholds a row lies beyond. A comparison, but for rows tied at one."""
    beyond, tied = F.lit(0), F.lit(False)
    for c, marks in thresholds.items():
        mine = F.col(label) == F.lit(c)
        passed = sum([(F.col("_order") > F.lit(t.value)).cast("int") for t in marks], F.lit(0))
        beyond = F.when(mine, passed).otherwise(beyond)
        for t in marks:
            if t.take < t.ties:
                tied = tied | (mine & (F.col("_order") == F.lit(t.value)))
    dealt = rows.withColumn(name, beyond)
    if all(t.take == t.ties for marks in thresholds.values() for t in marks):
        return dealt
    # Rows that share a key at a threshold: few, unless the key tells no rows apart.
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in (label, *key)]
    place = F.row_number().over(W.partitionBy(label, "_order").orderBy(*key, *rest))
    extra = F.lit(0)
    for c, marks in thresholds.items():
        over = sum([((F.col("_order") == F.lit(t.value)) & (place > t.take)).cast("int") for t in marks if t.take < t.ties], F.lit(0))
        extra = F.when(F.col(label) == F.lit(c), over).otherwise(extra)
    return dealt.filter(~tied).unionByName(dealt.filter(tied).withColumn(name, F.col(name) + extra))


def _class_sizes(df: DataFrame, label: str) -> dict[object, int]:
    return {r[0]: r[1] for r in df.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], test_size: float = 0.2, seed: int = 42, ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """Add ``split``: 'test' for exactly the quota of each class, 'train' for the rest, null where the label is null.

    Test rows are those of a class up to the quota's place in the order of the seeded hash. ``df`` is read a few
    times: pass a stored table. ``key`` should tell rows apart.
    """
    ordered = df.withColumn("_order", hash_order(key, seed))
    rows = ordered.filter(F.col(label).isNotNull())
    quotas = {r["_class"]: r["_quota"] for r in class_quotas(df, label, test_size).collect()}  # a row a class
    marks = rank_thresholds(rows, label, {c: [int(q)] for c, q in quotas.items() if q > 0}, ranked_rows)
    dealt = _dealt(rows, label, key, marks, "_beyond")
    has_test = F.col(label).isin(list(marks)) if marks else F.lit(False)
    split = dealt.withColumn("split", F.when(has_test & (F.col("_beyond") == 0), "test").otherwise("train"))
    unlabelled = ordered.filter(F.col(label).isNull()).withColumn("split", F.lit(None).cast("string"))
    return split.select(*df.columns, "split").unionByName(unlabelled.select(*df.columns, "split"))


def stratified_folds(
    df: DataFrame, label: str, key: Sequence[str], folds: int = 5, seed: int = 42, name: str = "fold", ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """Add a fold number in [0, folds): each class is cut evenly along its hash order; null where the label is null.

    Fold sizes of a class differ by one row at most: fold f ends at rank ceil((f + 1) * n / folds).
    """
    ordered = df.withColumn("_order", hash_order(key, seed))
    rows = ordered.filter(F.col(label).isNotNull())
    ends = {c: [-(-(f + 1) * n // folds) for f in range(folds - 1)] for c, n in _class_sizes(df, label).items()}
    dealt = _dealt(rows, label, key, rank_thresholds(rows, label, ends, ranked_rows), name)
    unlabelled = ordered.filter(F.col(label).isNull()).withColumn(name, F.lit(None).cast("int"))
    kept = [c for c in df.columns if c != name]
    return dealt.select(*kept, name).unionByName(unlabelled.select(*kept, name))
