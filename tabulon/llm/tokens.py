"""Token counts of a unigram vocabulary: an Aho-Corasick automaton feeds a Viterbi pass that keeps counts only."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabulon.llm.common import chunks

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_SEGMENTS = 300_000
KEPT_CHARACTERS = 50_000_000
# Fewer segments of like length than this are cheaper one after another than together.
TOGETHER = 64


class UnigramCounter:
    """Counts the pieces of the best segmentation under a unigram vocabulary.

    ``pieces`` maps piece text to score. The rules are those of the public
    tokenizers: the best path maximises the sum of scores; for one end, starts
    are tried from left to right and only a better sum replaces the path, so
    ties go to the longest last piece; a character without a piece of its own
    costs the lowest score less ten and counts one per UTF-8 byte.

    A text is cut before it is scored wherever no piece could cross: at runs of
    spaces and around characters that no longer piece holds. The best path of
    the whole is then the best paths of the segments, and equal segments are
    scored once; a long segment (letters without a space) is walked in time and
    memory that do not depend on the others. Sums are doubles; with the integer scores of the supplied
    files they are exact, so cutting changes no tie.
    """

    def __init__(self, pieces: dict[str, float], lowest: float | None = None):
        self.unknown = (min(pieces.values()) if lowest is None else lowest) - UNKNOWN_PENALTY
        inner = {c for p in pieces if len(p) > 1 for c in p}
        crossing = any(SPACE in p.lstrip(SPACE) for p in pieces)
        # Only characters of longer pieces can stand beside others in a piece; a character apart is a segment.
        joined = "".join(map(re.escape, sorted(inner - {SPACE})))
        word = f"[{joined}]+" if joined else "(?!)"
        if crossing:
            self.cut = re.compile(f"[{joined}{SPACE}]+|[\\s\\S]")
        else:
            self.cut = re.compile(f"{SPACE}*{word}|{SPACE}+|[\\s\\S]")
        self._build({p.encode(): s for p, s in pieces.items() if p})
        self.seen: dict[str, int] = {}
        self.kept = 0

    def _build(self, pieces: dict[bytes, float]) -> None:
        """Trie by levels, failure links and the closed transition table over bytes."""
        child: list[dict[int, int]] = [{}]
        final: dict[int, bytes] = {}
        for p in pieces:
            at = 0
            for byte in p:
                nxt = child[at].get(byte)
                if nxt is None:
                    nxt = child[at][byte] = len(child)
                    child.append({})
                at = nxt
            final[at] = p
        n = len(child)
        self.go = np.zeros((n, 256), dtype=np.int32)
        self.size = np.zeros(n, dtype=np.int32)  # length of the piece that ends in a state
        self.score = np.zeros(n, dtype=np.float64)
        self.out = np.zeros(n, dtype=np.int32)  # nearest state, this one included, whose text is a piece
        self.more = np.zeros(n, dtype=np.int32)  # the next shorter such state
        for state, p in final.items():
            self.size[state], self.score[state] = len(p), pieces[p]
        fail = np.zeros(n, dtype=np.int32)
        level = [0]
        while level:
            below = []
            for state in level:
                kids = child[state]
                if state:
                    self.go[state] = self.go[fail[state]]
                for byte, kid in kids.items():
                    fail[kid] = self.go[fail[state], byte] if state else 0
                    self.more[kid] = self.out[fail[kid]]
                    self.out[kid] = kid if self.size[kid] else self.more[kid]
                    self.go[state, byte] = kid
                    below.append(kid)
            level = below

        self.longest = int(self.size.max())
        self.plain = (memoryview(self.go.reshape(-1)), self.out.tolist(), self.more.tolist(), self.size.tolist(),
                      self.score.tolist())

    def _walk(self, segment: bytes) -> int:
        """Piece count of one segment of any length; only as many ends are kept as a piece can reach back."""
        go, out, more, size, score = self.plain
        mask = (1 << max(3, self.longest.bit_length())) - 1  # also holds the four bytes of an unknown character
        best, count = [-np.inf] * (mask + 1), [0] * (mask + 1)
        best[0], state, begin, n, unknown = 0.0, 0, 0, len(segment), self.unknown
        for p, byte in enumerate(segment):
            if byte & 0xC0 != 0x80:
                begin = p
            state = go[state << 8 | byte]
            end, top, pieces, known = p + 1, -np.inf, 0, False
            at = out[state]
            while at:
                start = end - size[at]
                got = best[start & mask] + score[at]
                if got > top:
                    top, pieces = got, count[start & mask] + 1
                if start == begin:
                    known = True
                at = more[at]
            if not known and (end == n or segment[end] & 0xC0 != 0x80):
                got = best[begin & mask] + unknown
                if got > top:
                    top, pieces = got, count[begin & mask] + end - begin
            best[end & mask], count[end & mask] = top, pieces
        return count[n & mask]

    def _score(self, segments: list[bytes]) -> np.ndarray:
        """Piece counts of segments given longest first, all advanced byte by byte together."""
        sizes = np.array([len(s) for s in segments])
        width, n = int(sizes[0]), len(segments)
        text = np.zeros((n, width), dtype=np.uint8)
        flat = np.frombuffer(b"".join(segments), dtype=np.uint8)
        text[np.arange(width) < sizes[:, None]] = flat
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0.0
        count = np.zeros((n, width + 1), dtype=np.int32)
        state = np.zeros(n, dtype=np.int32)
        begin = np.zeros(n, dtype=np.int64)  # where the current character starts
        rows_at = np.searchsorted(-sizes, -np.arange(width), side="left")  # segments longer than p
        for p in range(width):
            k = rows_at[p]
            byte = text[:k, p]
            lead = (byte & 0xC0) != 0x80
            begin[:k][lead] = p
            state[:k] = self.go[state[:k], byte]
            last = np.ones(k, dtype=bool)  # the character ends here
            inside = rows_at[p + 1] if p + 1 < width else 0
            if inside:
                last[:inside] = (text[:inside, p + 1] & 0xC0) != 0x80
            hit = self.out[state[:k]]
            known = np.zeros(k, dtype=bool)
            rows = np.flatnonzero(hit)
            at = hit[rows]
            while rows.size:
                start = p + 1 - self.size[at]
                got = best[rows, start] + self.score[at]
                better = got > best[rows, p + 1]
                r, s = rows[better], start[better]
                best[r, p + 1] = got[better]
                count[r, p + 1] = count[r, s] + 1
                known[rows] |= start == begin[rows]
                at = self.more[at]
                rows, at = rows[at > 0], at[at > 0]
            rows = np.flatnonzero(last & ~known)
            if rows.size:
                start = begin[rows]
                got = best[rows, start] + self.unknown
                better = got > best[rows, p + 1]
                r, s = rows[better], start[better]
                best[r, p + 1] = got[better]
                count[r, p + 1] = count[r, s] + (p + 1 - s)
        return count[np.arange(n), sizes]

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Counts for texts; null and empty texts have none. A text starts with a space mark, as the tokenizers add one."""
        cut = [self.cut.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        seen = self.seen
        fresh = {s for parts in cut for s in parts if s not in seen}
        coded = sorted(((s.encode(), s) for s in fresh), key=lambda x: len(x[0]), reverse=True)
        at = 0
        while at < len(coded):  # groups of like length, bounded in bytes
            width, to = len(coded[at][0]), at
            while to < len(coded) and (to - at) * width < 4_000_000 and 2 * len(coded[to][0]) >= width:
                to += 1
            to = max(to, at + 1)
            group = [b for b, _ in coded[at:to]]
            scored = [self._walk(b) for b in group] if len(group) < TOGETHER else self._score(group).tolist()
            seen.update(zip((s for _, s in coded[at:to]), scored))
            at = to
        self.kept += sum(map(len, fresh))
        out = np.array([sum(map(seen.__getitem__, parts)) for parts in cut], dtype=np.int64)
        if len(seen) > KEPT_SEGMENTS or self.kept > KEPT_CHARACTERS:  # forgetting only costs scoring again
            seen.clear()
            self.kept = 0
        return out


def piece_scores(path: str) -> dict[str, float]:
    """Ordinary pieces of a sentencepiece file with their scores (controls, bytes and the unknown piece left out)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): float(model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))}


@lru_cache(maxsize=2)
def _counter(path: str) -> UnigramCounter:
    return UnigramCounter(piece_scores(path))


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Add ``n_tokens`` (long) to each row by the unigram reading of the vocabulary file at ``vocabulary``.

    Whole texts of any length, with or without spaces; null and empty texts count 0; repeated rows are counted alike;
    an input column named ``n_tokens`` is replaced. ``docs`` needs ``text``. No
    row leaves its task: the automaton is built once per Python worker.
    """
    kept = [f for f in docs.drop("n_tokens").schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for part in chunks(batches, 8_000_000):
            counts = counter.count(part["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[part[f.name] for f in kept], pa.array(counts)], names=[*[f.name for f in kept], "n_tokens"])

    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType())])
    return docs.select(*[f.name for f in kept], "text").mapInArrow(run, schema)
