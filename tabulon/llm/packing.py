"""Packing documents into fixed windows: repeat counts of length combinations by non-negative least squares."""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import chunks, running_start, stage

END_ID = 1
# Beyond these characters Unicode versions of the two libraries may differ in what is a letter.
_OTHER = re.compile("[^\x00-\x7f¡-ɏ‐-‧]|<\\|endoftext\\|>")


@lru_cache(maxsize=2)
def _encoders(path: str, ranks_path: str | None):
    """The tokenizer file, and the same vocabulary as ranks (faster) where it is given."""
    from tokenizers import Tokenizer

    fast = None
    if ranks_path:
        import base64

        import tiktoken
        from public_tokenizers import PATTERN

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(path), fast


def encode(texts: list[str | None], path: str, ranks_path: str | None = None) -> Iterator[np.ndarray]:
    """Ids of each text followed by the end id, as little-endian unsigned 32-bit integers.

    The file at ``ranks_path`` holds the same vocabulary and gives the same ids
    several times faster; texts with other than Latin characters, or with the
    special token's string, go through the tokenizer file itself.
    """
    slow, fast = _encoders(path, ranks_path)
    for text in texts:
        text = text or ""
        if fast is not None and not _OTHER.search(text):
            ids = fast.encode_to_numpy(text, disallowed_special=())
        else:
            ids = np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        yield np.append(ids.astype("<u4"), np.array([END_ID], dtype="<u4"))


def token_pieces(docs: DataFrame, window: int, path: str, ranks_path: str | None = None) -> DataFrame:
    """Per document its number of ids and the CRC of each run of ``window`` ids, the last run being shorter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 8_000_000):
            n, crcs = [], []
            for ids in encode(part["text"].to_pylist(), path, ranks_path):
                n.append(len(ids))
                crcs.append([zlib.crc32(ids[a:a + window].tobytes()) for a in range(0, len(ids), window)])
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))],
                names=["doc_id", "doc_tokens", "crcs"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, doc_tokens long, crcs array<long>")


def combinations(lengths: list[int], window: int, triples_each: int = 4) -> list[tuple[int, ...]]:
    """Shallow combinations that fill the window exactly: all pairs, and for each length some triples of present lengths."""
    there, out = set(lengths), set()
    for x in lengths:
        if window - x in there:
            out.add(tuple(sorted((x, window - x))))
        rest = window - x
        near = bisect.bisect_left(lengths, rest / 2)
        found = 0
        for y in lengths[near:]:
            if rest - y <= 0 or found == triples_each:
                break
            if rest - y in there:
                out.add(tuple(sorted((x, y, rest - y))))
                found += 1
    return sorted(out)


def solve_repeats(histogram: dict[int, int], combos: list[tuple[int, ...]], sweeps: int = 30) -> np.ndarray:
    """x >= 0 that minimises |A x - h|^2, column c of A holding how often combination c uses each length.

    Coordinate descent: each repeat count moves to its best value given the
    others and stops at zero. The size of the problem depends on the window only.
    """
    left = dict(histogram)
    uses = [[(v, c.count(v)) for v in sorted(set(c))] for c in combos]
    norms = [sum(m * m for _, m in u) for u in uses]
    x = np.zeros(len(combos))
    for _ in range(sweeps):
        moved = 0.0
        for i, u in enumerate(uses):
            step = max(sum(m * left[v] for v, m in u) / norms[i], -x[i])
            if step:
                x[i] += step
                for v, m in u:
                    left[v] -= m * step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def plan_patterns(histogram: dict[int, int], window: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ((length, times) ..., repeats) that use up the histogram, none longer than the window.

    First the rounded-down repeats of the exact combinations, then the residual
    greedily: the longest length left, filled with the longest that still fits,
    repeated as often as what is left allows.
    """
    left = {v: n for v, n in histogram.items() if n > 0}
    combos = combinations(sorted(left), window)
    out: list[tuple[list[tuple[int, int]], int]] = []
    solved = solve_repeats(left, combos)
    for i in np.argsort(-solved, kind="stable"):
        parts = [(v, combos[i].count(v)) for v in sorted(set(combos[i]), reverse=True)]
        repeats = min([int(solved[i] + 1e-6), *(left[v] // m for v, m in parts)])
        if repeats > 0:
            out.append((parts, repeats))
            for v, m in parts:
                left[v] -= m * repeats
    lengths = sorted(v for v, n in left.items() if n)
    while lengths:
        room, parts, top = window, [], len(lengths)
        while room and (top := bisect.bisect_right(lengths, room, 0, top)):
            v = lengths[top - 1]
            times = min(left[v], room // v)
            parts.append((v, times))
            room -= v * times
            top -= 1
        repeats = min(left[v] // m for v, m in parts)
        out.append((parts, repeats))
        for v, m in parts:
            left[v] -= m * repeats
            if not left[v]:
                lengths.remove(v)
    return out


def pack_documents(docs: DataFrame, path: str, ranks_path: str | None = None, window: int = 2048,
                   rows_per_bucket: int = 20_000) -> DataFrame:
    """Pack all documents (``doc_id``, ``text``) into sequences of at most ``window`` ids.

    Returns a row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``. Documents are cut only where a whole window is full;
    such runs are sequences of their own. The histogram of what remains of each
    document (``window`` - 1 counts, whatever the input) is solved on the driver
    into patterns; the k-th remainder of a length then finds its sequence and
    offset by comparing k with the patterns' running totals, so no row is held
    together with others. Texts are tokenised once and only CRCs are kept.

    Null and empty texts are the end id alone; repeated rows are packed one by
    one; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = stage(token_pieces(docs, window, path, ranks_path), "pack-tokens")
    texts = texts.withColumns({"_full": F.floor(F.col("doc_tokens") / window).cast("long"),
                               "_rest": F.pmod("doc_tokens", F.lit(window)).cast("long")})
    counts = texts.groupBy("_rest").agg(F.count("*").alias("n"), F.sum("_full").alias("full"))
    by_rest = {r["_rest"]: (r["n"], r["full"]) for r in counts.collect()}  # at most `window` rows
    patterns = plan_patterns({v: n for v, (n, _) in by_rest.items() if v}, window)

    rows, used, sequence = [], dict.fromkeys(by_rest, 0), 0
    for parts, repeats in patterns:
        at = 0
        for v, m in parts:
            rows.append((v, used[v], used[v] + m * repeats, sequence, m, at))
            used[v] += m * repeats
            at += v * m
        sequence += repeats
    slots = spark.createDataFrame(rows, "_len long, _lo long, _hi long, _first long, _times long, _at long")

    buckets = max(1, math.ceil(sum(n for n, _ in by_rest.values()) / rows_per_bucket))
    tie = ["doc_id", "doc_tokens", "crcs"]
    rests = running_start(texts.filter("_rest > 0"), ["_rest"], F.lit(1), tie, "_k", buckets)
    # Bounded by the window: a few entries for each length below it.
    rests = rests.join(F.broadcast(slots), (F.col("_rest") == F.col("_len")) & (F.col("_k") >= F.col("_lo"))
                       & (F.col("_k") < F.col("_hi")))
    turn = F.col("_k") - F.col("_lo")
    rests = rests.select(
        "doc_id", (F.col("_full") * window).alias("start"), F.col("_rest").alias("length"),
        F.element_at("crcs", -1).alias("ids_crc32"), "doc_tokens",
        (F.col("_first") + F.floor(turn / F.col("_times"))).alias("sequence_id"),
        (F.col("_at") + F.pmod(turn, F.col("_times")) * F.col("_rest")).alias("offset"))
    fulls = running_start(texts.filter("_full > 0"), [], F.col("_full"), tie, "_k", buckets)
    fulls = fulls.select("doc_id", "doc_tokens", "_k", F.posexplode(F.slice("crcs", F.lit(1), F.col("_full").cast("int"))))
    fulls = fulls.select(
        "doc_id", (F.col("pos").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"),
        F.col("col").alias("ids_crc32"), "doc_tokens",
        (F.lit(sequence).cast("long") + F.col("_k") + F.col("pos")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return rests.unionByName(fulls)
