"""Conversation structure repair: a run-length dynamic program over role and fault symbols."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import SEPARATORS, WORD, ordered_sha256, stage, stage_twice
from tabulon.operators.ordering import with_position

#: Rows of one conversation whose symbols are put together in one group before they are joined into one string.
CHUNK = 4096
#: Runs between two stored cost vectors; those in between are computed again when choices are unrolled.
STORED_EVERY = 4096

# Fixed by the contract: costs of the edits, and the edits' initials by which ties are broken (ASCII-least first).
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# A row's symbol: its role's initial (s, u, a or another, o), upper case if truncated, a digit if it must go.
_OK, _CUT, _GONE = "suao", "SUAO", "1234"
INFINITE = 1 << 60

# States of what is written so far: nothing, a leading s, a u that waits for its a, a complete pair.
_START, _SYSTEM, _USER, _PAIR = range(4)
_NEXT = {"s": {_START: _SYSTEM}, "u": {_START: _USER, _SYSTEM: _USER, _PAIR: _USER}, "a": {_USER: _PAIR}, "o": {}}
_WRITES = {_START: "user", _SYSTEM: "user", _USER: "assistant", _PAIR: "user"}  # what a rerole or insert may write
_AFTER = {_START: _USER, _SYSTEM: _USER, _USER: _PAIR, _PAIR: _USER}

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]
_INSERTS: Matrix = ((0, INFINITE, 2, 4), (INFINITE, 0, 2, 4), (INFINITE, INFINITE, 0, 2), (INFINITE, INFINITE, 2, 0))
_END: Vector = (0, 2 * INSERT, INSERT, 0)


def row_edits(symbol: str) -> list[tuple[str, int, dict[int, int]]]:
    """(initial, cost, state to state) of the edits that use up one row of a symbol, ASCII order but for inserts."""
    delete = ("D", DELETE, {s: s for s in range(4)})
    if symbol in _GONE:
        return [delete]
    extra = TRUNCATED if symbol in _CUT else 0
    return [delete, ("K", extra, _NEXT[symbol.lower()]), ("R", REROLE + extra, _AFTER)]


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product."""
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in range(4)), INFINITE) for j in range(4)) for i in range(4))


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple([min(r[0] + v[0], r[1] + v[1], r[2] + v[2], r[3] + v[3]) for r in a])


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """Transition of 2^k equal rows, each with any inserts before it (at most 9 symbols by 31 powers)."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    row = [[INFINITE] * 4 for _ in range(4)]
    for _, cost, moves in row_edits(symbol):
        for s, t in moves.items():
            row[s][t] = min(row[s][t], cost)
    return times(_INSERTS, tuple(map(tuple, row)))


def ahead(symbol: str, n: int, v: Vector) -> Vector:
    """Costs to go before ``n`` equal rows, given those after them."""
    k = 0
    while n:
        if n & 1:
            v = apply(power(symbol, k), v)
        n >>= 1
        k += 1
    return v


@lru_cache(maxsize=65_536)
def _one_row(symbol: str, state: int, after: Vector) -> tuple[str, int]:
    """Initials of the least cheapest edits up to and with one row, and the state reached. ``after`` is relative."""
    out = ""
    goal = apply(power(symbol, 0), after)
    while True:
        left = goal[state]
        edits = row_edits(symbol)
        for initial, cost, moves in [edits[0], ("I", INSERT, None), *edits[1:]]:
            if initial == "I":
                if INSERT + goal[_AFTER[state]] == left:
                    out, state = out + "I", _AFTER[state]
                    break
            elif state in moves and cost + after[moves[state]] == left:
                return out + initial, moves[state]


def _unroll(symbol: str, n: int, state: int, after: Vector) -> tuple[str, int]:
    """Choices of a run, halved down to single rows with the powers for the costs in the middle."""
    out: list[str] = []
    todo = [(n, after)]
    while todo:
        n, v = todo.pop()
        if n == 1:
            low = min(v)
            text, state = _one_row(symbol, state, tuple([min(x - low, INFINITE) for x in v]))
            out.append(text)
        else:
            right = n // 2
            todo.append((right, v))
            todo.append((n - right, ahead(symbol, right, v)))
    return "".join(out), state


def plan(symbols: str) -> tuple[int, str]:
    """Least cost and the ASCII-least cheapest audit of a conversation's rows.

    Equal consecutive symbols are one run; costs to go move back over a run by the binary powers of its min-plus
    transition, then choices are unrolled forwards. Memory beyond symbols and audit: a vector for every
    ``STORED_EVERY`` runs.
    """
    codes = np.frombuffer(symbols.translate(_FOLD).encode(), dtype=np.uint8)
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(codes)))
    v, stored = _END, {}
    for i in range(len(starts) - 1, -1, -1):
        if i % STORED_EVERY == STORED_EVERY - 1 or i == len(starts) - 1:
            stored[i // STORED_EVERY] = v
        v = ahead(chr(codes[starts[i]]), int(sizes[i]), v)
    cost, state, out = v[_START], _START, []
    for block in range(-(-len(starts) // STORED_EVERY)):
        first, last = block * STORED_EVERY, min(len(starts), (block + 1) * STORED_EVERY)
        after = [stored[block]]
        for i in range(last - 1, first, -1):
            after.append(ahead(chr(codes[starts[i]]), int(sizes[i]), after[-1]))
        for i in range(first, last):
            text, state = _unroll(chr(codes[starts[i]]), int(sizes[i]), state, after[last - 1 - i])
            out.append(text)
    while _END[state]:
        out.append("I")
        state = _AFTER[state]
    return cost, "".join(out)


_FOLD = str.maketrans(_GONE, "1111")  # rows that must go are alike for the edits


@lru_cache(maxsize=65_536)
def _short_plan(symbols: str) -> tuple[int, str]:
    return plan(symbols)


_INITIALS = str.maketrans(_CUT + _GONE, _OK + _OK)


def illegal_pairs(symbols: str) -> int:
    """Neighbouring rows whose role initials aren't su, ua or au."""
    at = np.frombuffer(symbols.translate(_INITIALS).encode(), dtype=np.uint8).astype(np.int64)
    pair = at[:-1] * 256 + at[1:]
    return int(len(pair) - np.isin(pair, [ord(a) * 256 + ord(b) for a, b in ("su", "ua", "au")]).sum())


def damaged(conversations: DataFrame) -> DataFrame:
    """Damage by crc32 of ``conv_id:turn`` modulo 20, nulls being one space.

    0 drops a row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it, 4 makes
    its role user; all others stay.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                                (F.crc32(key.cast("binary")) % 20).alias("_d")).filter("_d <> 0")
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def inspected(turns: DataFrame) -> DataFrame:
    """(``conv_id``, ``position``, ``turn``, ``role``, ``text``, ``fault``, ``symbol``); the result is stored.

    Rows are in the order of turn (nulls first), then role and text. The first fault counts: blank (no character but
    spaces), duplicate (role and text seen earlier in the conversation), truncated (the last such character is none
    of ``.!?``). Nulls of role and text are one space.
    """
    rows = turns.select("conv_id", F.col("turn").isNotNull().alias("_timed"), "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"))
    placed = with_position(rows, ["_timed", "turn", "role", "text"], ["conv_id"])
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    placed = stage(placed.select("conv_id", F.col("position").cast("long").alias("position"), "turn", "role", "text",
                                 F.unhex(F.sha2(said.cast("binary"), 256)).alias("_said")), "turns-placed")
    # First places of what is said more than once: partial minima, so a turn repeated without end is a row a task.
    firsts = placed.groupBy("conv_id", "_said").agg(F.min("position").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    firsts = firsts.select(F.col("conv_id").alias("_c"), F.col("_said").alias("_s"), "_first")
    joined = placed.join(firsts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_said") == F.col("_s")), "left")
    inked = F.rtrim(F.col("text"), F.lit(SEPARATORS))
    fault = (F.when(~F.rlike("text", F.lit(WORD)), "blank").when(F.col("_first") < F.col("position"), "duplicate")
             .when(~F.substring(inked, -1, 1).isin(".", "!", "?"), "truncated"))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = (F.when(F.col("fault").isNull(), initial).when(F.col("fault") == "truncated", F.upper(initial))
              .otherwise(F.translate(initial, _OK, _GONE)))
    return stage(joined.withColumn("fault", fault).select(
        "conv_id", "position", "turn", "role", "text", "fault", symbol.alias("symbol")), "turns-inspected")


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation of inspected rows: gaps, counts of faults, ``illegal``, ``cost`` and ``audit``.

    The symbols of a conversation are put together in chunks and then as one string of a character a row, which is
    no longer than the audit that is returned for it; texts stay where they are. ``gaps`` is null if turns lie
    further apart than a long can say.
    """
    pairs = F.array_sort(F.collect_list(F.struct("position", "symbol")))
    chunks = rows.groupBy("conv_id", F.expr(f"position div {CHUNK}").alias("_chunk")).agg(
        F.array_join(F.transform(pairs, lambda p: p["symbol"]), "").alias("_s"),
        F.min("turn").alias("_low"), F.max("turn").alias("_high"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    whole = F.array_sort(F.collect_list(F.struct("_chunk", "_s")))
    convs = chunks.groupBy("conv_id").agg(
        F.array_join(F.transform(whole, lambda p: p["_s"]), "").alias("symbols"), F.min("_low").alias("_low"), F.max("_high").alias("_high"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    turns = rows.filter("turn is not null").select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("_c")).agg(
        F.count("*").alias("_turns"))
    width = F.try_add(F.try_subtract("_high", "_low"), F.lit(1).cast("long"))
    gaps = F.when(F.col("_turns").isNull(), F.lit(0).cast("long")).otherwise(width - F.col("_turns"))
    counted = convs.join(turns, F.col("conv_id").eqNullSafe(F.col("_c")), "left").select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "symbols")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = batch["symbols"].to_pylist()
            found = [_short_plan(s) if len(s) < 64 else plan(s) for s in symbols]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in kept], pa.array([illegal_pairs(s) for s in symbols], pa.int64()),
                 pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                names=[*kept, "illegal", "cost", "audit"])

    kept = ["conv_id", "gaps", "blank", "duplicate", "truncated", "symbols"]
    id_type = rows.schema["conv_id"].dataType.simpleString()
    return counted.mapInArrow(run, f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, symbols string, "
                                   "illegal long, cost long, audit string")


def written_edits(symbols: str, audit: str, batch: int = 100_000) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """The lines that an audit writes, some at a time: the row each takes its text from and its new role (null: its own)."""
    state, row = _START, 0
    rows: list[int | None] = []
    roles: list[str | None] = []
    for edit in audit:
        if edit == "D":
            row += 1
            continue
        rows.append(None if edit == "I" else row)
        if edit == "K":
            roles.append(None)
            state = _NEXT[symbols[row].lower()][state]
        else:
            roles.append(_WRITES[state])
            state = _AFTER[state]
        row += edit != "I"
        if len(rows) == batch:
            yield rows, roles
            rows, roles = [], []
    if rows:
        yield rows, roles


def repaired_turns(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired conversations, a row a turn: (``conv_id``, ``place`` from 0, ``role``, ``text``)."""
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["conv_id"]
            which: list[int] = []
            places: list[int] = []
            source: list[int | None] = []
            role: list[str | None] = []
            for n, (symbols, audit) in enumerate(zip(batch["symbols"].to_pylist(), batch["audit"].to_pylist())):
                place = 0
                for some, new in written_edits(symbols, audit):
                    which += [n] * len(some)
                    places += range(place, place + len(some))
                    source += some
                    role += new
                    place += len(some)
                    if len(which) >= 100_000:
                        yield edits(ids, which, places, source, role)
                        which, places, source, role = [], [], [], []
            if which:
                yield edits(ids, which, places, source, role)

    def edits(ids, which, places, source, role) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(which)), pa.array(places, pa.int64()), pa.array(source, pa.int64()), pa.array(role, pa.string())],
            names=["_c", "place", "_row", "_role"])

    lines = planned.select("conv_id", "symbols", "audit").mapInArrow(run, f"_c {id_type}, place long, _row long, _role string")
    told = rows.select("conv_id", "position", "role", "text")
    same = F.col("_c").eqNullSafe(F.col("conv_id")) & (F.col("_row") == F.col("position"))
    # Inserts have no row to take a text from.
    return lines.filter("_row is not null").join(told, same).select(
        F.col("_c").alias("conv_id"), "place", F.coalesce("_role", "role").alias("role"), "text",
    ).unionByName(lines.filter("_row is null").select(
        F.col("_c").alias("conv_id"), "place", F.col("_role").alias("role"), F.lit("").alias("text")))


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cheapest edits that make every conversation ``(system? (user assistant)+)?``, and the repaired turns.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns are not read. Roles count by their
    initial. Keep costs 0, rerole to user or assistant 2, delete 3 (blank and duplicate rows must go), insert an
    empty turn 2; a truncated row that stays costs 1 more. Of the cheapest edits the ASCII-least initials count.

    Returns (``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``symbols``, ``illegal``, ``cost``,
    ``audit``) and the turns (``conv_id``, ``place``, ``role``, ``text``).

    Null ids are one conversation; null turns come first; null roles and texts are one space; ties in turn are
    ordered by role and text; repeated rows are duplicates, but the first. An empty table gives empty ones. Very
    long texts are sorted and hashed as streams; of a very long conversation only its symbols come together.
    """
    rows = inspected(turns)
    planned, again = stage_twice(plans(rows), "repair-plans")
    return planned, repaired_turns(rows, again)


def repair_digest(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """One row for every conv_id of the table, repaired after ``damage``; see ``repair``.

    A conversation that has no rows after the damage has zeros, an empty audit and the empty text's hash.
    """
    planned, lines = repair(damaged(conversations) if damage else conversations)
    told = lines.withColumn("_line", F.concat("role", F.lit(":"), "text"))
    hashes = ordered_sha256(told, ["conv_id"], ["place"], "_line", "\n", "repaired_sha256").withColumnRenamed("conv_id", "_h")
    every = conversations.select(F.col("conv_id").alias("_every")).distinct()
    zero = F.lit(0).cast("long")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    joined = every.join(planned, F.col("_every").eqNullSafe(F.col("conv_id")), "left").join(
        hashes, F.col("_every").eqNullSafe(F.col("_h")), "left")
    return joined.select(
        F.col("_every").alias("conv_id"), *[F.when(F.col("audit").isNull(), zero).otherwise(F.col(c)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
