"""Removal of repeated passages: windows of words counted exactly in minimiser buckets of packed runs."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import Words, chunks, mix, powers, run_hashes, stage

WINDOW = 35
MINIMISER = 4
# Sizes are in words carried: a run of n windows carries its n + window - 1 words.
HOT_WORDS = 250_000
WORDS_PER_BUCKET = 750_000
# A text of one repeated word is a single run; longer runs are cut into overlapping pieces of so many windows.
RUN_WINDOWS = 4_096
_BLOCK = 4_096
_FLUSH = 100_000
COMPRESSION_LEVEL = 6
_BASE_A, _BASE_B, _BASE_M = 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have, span = x, 1
    while span * 2 <= width:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = width - span
    return np.minimum(have[:len(have) - rest], have[rest:]) if rest else have


class Runs:
    """The super-k-mers of a chunk of texts: runs of consecutive windows that share a minimiser.

    A window's minimiser is the smallest hash of the ``m`` consecutive words
    within it, so it depends on the window alone and equal windows meet in its
    bucket. ``first`` and ``last`` number the windows (by their first word in
    the chunk) of a run, ``key`` is its minimiser.
    """

    def __init__(self, words: Words, window: int, m: int):
        self.words = words
        n = len(words.start)
        self.first = self.last = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.int64)
        if n < window:
            return
        least = sliding_min(run_hashes(words.hashes(), m, _BASE_M), window - m + 1)
        at = np.flatnonzero(words.doc[:n - window + 1] == words.doc[window - 1:])
        if not len(at):
            return
        least = least[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
        heads = np.flatnonzero(new)
        self.first, self.last = at[heads], at[np.append(heads[1:], len(at)) - 1]
        self.key = least[heads].view(np.int64)


def split_words(raw: bytes) -> list[bytes]:
    """The words of a text: ``bytes.split`` cuts at the six separators and nothing else."""
    return raw.split()


def cut_runs(runs: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first``, ``last`` and ``key`` of the runs, cut into pieces of at most ``RUN_WINDOWS`` windows.

    Pieces share no window, so each window is still counted once.
    """
    parts = (runs.last - runs.first) // RUN_WINDOWS + 1
    run = np.repeat(np.arange(len(parts)), parts)
    number = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = runs.first[run] + number * RUN_WINDOWS
    return first, np.minimum(first + RUN_WINDOWS - 1, runs.last[run]), runs.key[run]


def count_runs(texts: DataFrame, window: int, m: int) -> DataFrame:
    """(``key``, ``n``): how many words the runs of each minimiser carry, summed per chunk first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 4_000_000):
            first, last, key = cut_runs(Runs(Words(part["text"]), window, m))
            keys, which = np.unique(key, return_inverse=True)
            n = np.zeros(len(keys), dtype=np.int64)
            np.add.at(n, which, last - first + window)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n)], names=["key", "n"])

    return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def send_runs(texts: DataFrame, hot: np.ndarray, buckets: int, window: int, m: int) -> DataFrame:
    """Packed runs on their way to their buckets: (``bucket``, ``blob``, ``owner``, ``at``).

    A row holds a chunk's runs for one bucket: their words as one compressed
    text with a line for each run, the addresses of their texts and the numbers of
    their first words. Runs of hot minimisers are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=COMPRESSION_LEVEL)
        for part in chunks(batches, 8_000_000):
            words = Words(part["text"])
            first, last, key = cut_runs(Runs(words, window, m))
            if len(hot):
                cold = ~np.isin(key, hot)
                first, last, key = first[cold], last[cold], key[cold]
            bucket = (mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            if not len(order):
                continue
            ids = part["content"].to_pylist()
            per = words.per_doc()
            doc_first = np.cumsum(per) - per
            data = words.data.tobytes()
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            out: list[tuple] = []
            start, end = words.start[first[order]], words.end[last[order] + window - 1]
            doc = words.doc[first[order]]
            at = (first[order] - doc_first[doc]).astype("<i4")
            for a, b in zip([0, *cuts], [*cuts, len(order)]):
                lines = b"\n".join(b" ".join(data[s:e].split()) for s, e in zip(start[a:b].tolist(), end[a:b].tolist()))
                out.append((int(bucket[order[a]]), codec.compress(lines, asbytes=True), len(lines),
                            b"".join(ids[d] for d in doc[a:b]), at[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                 pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.binary()),
                 pa.array([o[4] for o in out], pa.binary())], names=["bucket", "blob", "raw", "owner", "at"])

    return texts.select("content", "text").mapInArrow(
        run, "bucket long, blob binary, raw long, owner binary, at binary")


def repeated_windows(lines: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, number of its window) of every window that occurs more than once among the lines.

    Windows are sorted by two 64-bit hashes; within equal hashes their bytes are compared.
    """
    words = Words(lines)
    n = len(words.start)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none
    at = np.flatnonzero(words.doc[:n - window + 1] == words.doc[window - 1:])
    hashes = words.hashes()
    one, two = run_hashes(hashes, window, _BASE_A)[at], run_hashes(mix(hashes), window, _BASE_B)[at]
    order = np.lexsort((two, one))
    one, two, at = one[order], two[order], at[order]
    same = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
    again = np.zeros(len(at), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    data = words.data.tobytes()
    begin, end = words.start[at], words.end[at + window - 1]
    differs = [i for i in np.flatnonzero(same).tolist()
               if data[begin[i]:end[i]] != data[begin[i + 1]:end[i + 1]]]
    for i in differs:  # a hash shared by different windows: count that group by its bytes
        lo, hi = i, i + 1
        while lo > 0 and same[lo - 1]:
            lo -= 1
        while hi < len(same) and same[hi]:
            hi += 1
        texts = [data[begin[j]:end[j]] for j in range(lo, hi + 1)]
        for j, t in enumerate(texts):
            again[lo + j] = texts.count(t) > 1
    at = at[again]
    per = words.per_doc()
    doc = words.doc[at]
    return doc, at - (np.cumsum(per) - per)[doc]


def covered(line: np.ndarray, number: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of words (line, from, to) that repeated windows cover, one for each unbroken row of windows."""
    order = np.lexsort((number, line))
    line, number = line[order], number[order]
    new = np.ones(len(line), dtype=bool)
    new[1:] = (line[1:] != line[:-1]) | (number[1:] != number[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(line)) - 1
    return line[heads], number[heads], number[tails] + window if len(line) else number


def judge_buckets(sent: DataFrame, window: int) -> DataFrame:
    """(``content``, ``from``, ``to``) of repeated passages; each task takes its buckets one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judge(rows: list[dict]) -> pa.RecordBatch:
            text = b"\n".join(pa.decompress(r["blob"], r["raw"], "zstd", asbytes=True) for r in rows)
            owner = b"".join(r["owner"] for r in rows)
            at = np.frombuffer(b"".join(r["at"] for r in rows), dtype="<i4").astype(np.int64)
            lines = text.split(b"\n")
            line, low, high = covered(*repeated_windows(pa.array(lines, pa.large_binary()).cast(pa.large_string()), window), window)
            ids = np.frombuffer(owner, dtype="V16")[line]
            return pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(low + at[line], pa.int64()),
                 pa.array(high + at[line], pa.int64())], names=["content", "from", "to"])

        held: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch[k][i].as_py() for k in ("bucket", "blob", "raw", "owner", "at")}
                if held and row["bucket"] != held[0]["bucket"]:
                    yield judge(held)
                    held = []
                held.append(row)
        if held:
            yield judge(held)

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        run, "content binary, from long, to long")


def hot_windows(texts: DataFrame, hot: np.ndarray, window: int, m: int) -> DataFrame:
    """(``content``, ``from``, ``to``) of passages of repeated windows whose minimiser is hot.

    Their windows go one by one, as digests: Spark counts them with a partial
    sum in each task, so a passage that a third of all texts share is no group anywhere.
    Repeated windows that follow each other join in one range within each stretch of
    a text, so a text has few ranges at any length.
    """
    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary()),
             pa.array([o[2] for o in out], pa.int64())], names=["digest", "content", "from"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 4_000_000):
            words = Words(part["text"])
            pieces_first, pieces_last, key = cut_runs(Runs(words, window, m))
            ids, per = part["content"].to_pylist(), words.per_doc()
            doc_first = np.cumsum(per) - per
            out: list[tuple] = []
            for r in np.flatnonzero(np.isin(key, hot)).tolist():
                first, last = int(pieces_first[r]), int(pieces_last[r])
                doc = int(words.doc[first])
                own = split_words(words.data[words.start[first]:words.end[last + window - 1]].tobytes())
                for k in range(last - first + 1):
                    out.append((hashlib.md5(b" ".join(own[k:k + window])).digest(), ids[doc], first + k - int(doc_first[doc])))
                if len(out) >= _FLUSH:
                    yield rows(out)
                    out = []
            yield rows(out)

    each = stage(texts.select("content", "text").mapInArrow(run, "digest binary, content binary, from long"), "hot-windows")
    again = each.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    stretches = each.join(again, "digest", "left_semi").groupBy("content", F.floor(F.col("from") / _BLOCK)).agg(
        F.sort_array(F.collect_set("from")).alias("at"))
    at = F.col("at")
    heads = F.filter(at, lambda x, i: (i == 0) | (F.get(at, i - 1) != x - 1))
    tails = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (F.get(at, i + 1) != x + 1))
    return stretches.select("content", F.inline(F.arrays_zip(heads.alias("from"), tails.alias("to")))).toDF(
        "content", "from", "to").withColumn("to", F.col("to") + window)


def repeated_passages(texts: DataFrame, window: int = WINDOW, m: int = MINIMISER, hot_words: int = HOT_WORDS,
                      words_per_bucket: int = WORDS_PER_BUCKET) -> DataFrame:
    """(``content``, ``ranges``): for each text with any, the word ranges that repeated windows cover.

    ``texts`` has ``content`` (16 bytes that name the text) and ``text``, a row
    for each occurrence. The words that each minimiser's runs carry are counted
    first: the totals size the buckets, and minimisers of more than ``hot_words``
    (or a ten-thousandth of all, so there are at most 10,000 of them) are counted
    window by window. Texts may have any length, also of one word repeated.
    """
    # Keys below the bar at any size are only needed as a sum.
    counts = count_runs(texts, window, m).groupBy(F.when(F.col("n") > hot_words, F.col("key")).alias("key")).agg(F.sum("n").alias("n"))
    counts = stage(counts, "run-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bar = max(hot_words, total // 10_000)
    busy = counts.filter(F.col("key").isNotNull() & (F.col("n") > bar))
    hot = np.array(sorted(r["key"] for r in busy.select("key").collect()), dtype=np.int64)
    found = judge_buckets(send_runs(texts, hot, max(1, math.ceil(total / words_per_bucket)), window, m), window)
    if len(hot):
        found = found.unionByName(hot_windows(texts, hot, window, m))
    return found.groupBy("content").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, **options: int) -> DataFrame:
    """Drop the words covered by passages of ``window`` words that also start anywhere else.

    Windows are judged on the input. Returns ``doc_id, n_words, n_removed, kept``
    (the kept words joined by one space) and ``kept_sha256``, a row for each row
    of ``docs`` (``doc_id``, ``text``). Null and empty texts have no words; equal
    texts repeat each other; extra columns are not carried.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("content", F.unhex(F.md5("text")))
    ranges = repeated_passages(texts, window, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 4_000_000):
            n, removed, kept, digests = [], [], [], []
            raw = part["text"].cast(pa.large_string()).cast(pa.large_binary())
            for i in range(part.num_rows):
                own = split_words(raw[i].as_py())
                n.append(len(own))
                cut = part["ranges"][i].as_py()
                if cut:
                    drop = np.zeros(len(own) + 1, dtype=np.int64)
                    for r in cut:
                        drop[r["from"]] += 1
                        drop[r["to"]] -= 1
                    own = [w for w, d in zip(own, np.cumsum(drop[:-1]).tolist()) if not d]
                removed.append(n[-1] - len(own))
                text = b" ".join(own)
                kept.append(text.decode())
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return texts.join(ranges, "content", "left").select("doc_id", "text", "ranges").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
