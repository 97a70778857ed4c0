"""Benchmark decontamination: one Aho-Corasick automaton over normalised test texts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import chunks, stage

# Fixed by the contract: A-Z become a-z, then a word is a run of anything but these ASCII characters.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Bytes of windows in one automaton (at most a node of 40 bytes each); more make more automata, one pass each.
AUTOMATON_BYTES = 3_000_000

# The same rule on UTF-8 bytes: bytes from 0x80 on belong to words, other separators become spaces.
_FOLD = bytes(b if b >= 0x80 or chr(b) in LOWER + "0123456789" else b + 32 if chr(b) in UPPER else 32 for b in range(256))


def item_words(text: Column) -> Column:
    """Normalised words of a test text; null has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(ITEM_WORD), F.lit(0)), F.array().cast("array<string>"))


def item_windows(items: DataFrame, fields: Sequence[str] = ("text",), width: int = WINDOW) -> DataFrame:
    """Each distinct window (``words``, one space between two) with the sorted ``ids`` of its items.

    A field (question, answer) is a text of its own. A text of fewer than ``width`` words, but not none, is one
    window. Items with equal ids are one item; an item without an id has windows, but gives no id.
    """
    texts = items.select(F.col("item_id").cast("string").alias("_id"), F.explode(F.array(*[item_words(F.col(f)) for f in fields])).alias("_w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (width - 1), F.lit(1)))
    each = texts.filter(F.size("_w") > 0).select("_id", F.explode(
        F.transform(starts, lambda i: F.array_join(F.slice("_w", i, F.lit(width)), " "))).alias("words"))
    return each.groupBy("words").agg(F.sort_array(F.collect_set("_id")).alias("ids"))


def normalised(folded: bytes) -> bytes:
    """Words with one space before, between and after them."""
    text = b" " + folded + b" "
    while b"  " in text:  # halves every run of spaces
        text = text.replace(b"  ", b" ")
    return text


class Automaton:
    """The windows of one broadcast, each with a space at both ends, so that it matches whole words only."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.ids = [ids for _, ids in windows]
        self.size: list[int] = []
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n, (words, _) in enumerate(windows):
            text = b" " + words.encode() + b" "
            self.size.append(len(text))
            self.trie.add_word(text.decode("latin-1"), n)  # a character a byte
        if windows:
            self.trie.make_automaton()

    def find(self, text: bytes) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged half-open runs of hit words in a normalised text, and the windows found."""
        hits = list(self.trie.iter(text.decode("latin-1"))) if self.ids else []
        if not hits:
            return [], set()
        last, n = np.array([h[0] for h in hits]), np.array([h[1] for h in hits])
        spaces = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 32)
        first = np.searchsorted(spaces, last + 1 - np.array(self.size)[n])
        return merge_runs(list(zip(first.tolist(), np.searchsorted(spaces, last).tolist()))), set(n.tolist())


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_built: list[tuple[list, Automaton]] = []


def _automaton(windows: Broadcast) -> Automaton:
    """The automaton of a broadcast, built once per Python worker; only the last one is kept."""
    held = windows.value
    if not _built or _built[0][0] is not held:
        _built[:] = [(held, Automaton(held))]
    return _built[0][1]


def word_bounds(folded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a folded text, in code points of the original (folding moves nothing)."""
    raw = np.frombuffer(folded, dtype=np.uint8)
    ink = np.concatenate([[False], raw != 32, [False]])
    edge = np.flatnonzero(ink[1:] != ink[:-1])
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return points[edge[::2]], points[edge[1::2]]


_STATE = "struct<runs:array<struct<a:int,b:int>>,ids:array<string>,n_words:bigint,spans:array<struct<start:bigint,end:bigint>>>"


def _scan(rows: DataFrame, windows: Broadcast) -> DataFrame:
    """One pass over all texts: hits of this automaton are added to those in ``found``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(windows)
        for part in chunks(batches, 8_000_000):
            out = []
            for text, before in zip(part["text"].to_pylist(), part["found"].to_pylist()):
                folded = (text or "").encode().translate(_FOLD)
                words = normalised(folded)
                runs, hit = automaton.find(words)
                ids = {i for n in hit for i in automaton.ids[n]}
                if before:
                    runs = merge_runs(runs + [(r["a"], r["b"]) for r in before["runs"]])
                    ids |= set(before["ids"])
                spans = []
                if runs:
                    start, end = word_bounds(folded)
                    spans = [{"start": int(start[a]), "end": int(end[b - 1])} for a, b in runs]
                out.append({"runs": [{"a": a, "b": b} for a, b in runs], "ids": sorted(ids), "n_words": words.count(b" ") - 1, "spans": spans})
            found = pa.array(out, part.schema.field("found").type)
            yield pa.RecordBatch.from_arrays([part["_doc"], part["text"], found], names=["_doc", "text", "found"])

    return rows.mapInArrow(run, rows.schema)


def decontaminate(docs: DataFrame, items: DataFrame, fields: Sequence[str] = ("text",), width: int = WINDOW,
                  automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Add to each document what of the test items (``item_id``, ``fields``) it holds.

    ``n_words``; ``n_hit``, its words inside any occurrence of a window; ``items``, the sorted ids (as text) of the
    items with such windows; ``spans``, the hit stretches of the original text as (start, end) in code points.

    All windows go into one automaton, which reads every whole text once. It is broadcast, so its size is
    checked first: windows of more than ``automaton_bytes`` bytes are dealt to several automata by a hash of the
    window, each collected, broadcast and run in a pass of its own, with the hits of all passes merged in the row;
    nothing is left out. Windows can't be cut by documents, which are never shuffled.

    Null and empty texts have no words and no hits; without items, or with items that have no words, nothing is hit;
    repeated documents are judged alike; repeated items count once by id, and items without an id hit words but are
    not listed. A very long text is held in one task with a few times its size. Input columns of the added names are
    replaced; ``docs`` needs ``text``, all other columns stay. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    windows = stage(item_windows(items, fields, width), "item-windows")
    total = windows.agg(F.sum(F.octet_length("words") + F.size("ids"))).first()[0] or 0
    parts = max(1, math.ceil(total / automaton_bytes))
    kept = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "spans")]
    rows = docs.select(F.struct(*kept).alias("_doc"), "text", F.lit(None).cast(_STATE).alias("found"))
    for n in range(parts):
        mine = windows.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == n) if parts > 1 else windows
        held = spark.sparkContext.broadcast([(r["words"], r["ids"]) for r in mine.collect()])
        rows = _scan(rows, held)
        if n + 1 < parts:  # one automaton at a time in a worker's memory
            rows = stage(rows, "hits")
    hit = F.aggregate("found.runs", F.lit(0).cast("long"), lambda t, r: t + r["b"] - r["a"])
    return rows.select(*[F.col("_doc")[c].alias(c) for c in kept], F.col("found.n_words").alias("n_words"),
                       hit.alias("n_hit"), F.col("found.ids").alias("items"), F.col("found.spans").alias("spans"))
