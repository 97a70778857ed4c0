"""Prefix trie and structure repair against plain Python, with nulls, ties, repeats, long rows and clashing names."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest

from tabulon.llm import catalog, prefixes, repair
from tabulon.llm.common import ordered_sha256, stage

SCHEMA = "conv_id long, turn long, role string, text string, depth string, id int, symbols string"


def table(spark, rows, path):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    df.repartition(3).write.parquet(f"{path}/conversations.parquet")
    return str(path)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- prefix trie -------------------------------------------------------------------------------------------

def plain_trie(rows):
    told = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            told[c].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in told.values():
        turns.sort()
    built = {}
    for c in told:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = [t[2:] for t in told.get(base, [])[:h]] + [t[2:] for t in told[c][h:]]
    return plain_nodes(built)


def plain_nodes(built):
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for n in members:
        if n:
            kids[n[:-1]].add(n)
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, m in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
            leaves[n[:d]] += not kids[n]
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
         sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(n)))) for n, m in members.items())


def conversations(seed, n=60, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-30, n), 100, 101, 199, 350]:  # 300 is absent
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "assistant", "system", None, "tool"]),
                         rng.choice(["a", "b", "ö🙂", "", None, "word " * 30])))
    return rows + rows[:5] + [(None, 1, "user", "nobody"), (500, 1, "user", "one"), (2**62, 0, "user", "far")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_branched_conversations(spark, tmp_path, seed):
    rows = conversations(seed)
    got = catalog.op11(spark, table(spark, rows, tmp_path)).collect()
    assert sorted(map(tuple, got)) == plain_trie(rows)


@pytest.mark.parametrize("width", [1, 3, 8])
def test_long_conversations_go_on_in_further_blocks(spark, monkeypatch, width):
    monkeypatch.setattr(prefixes, "RUN", 4)
    monkeypatch.setattr(prefixes, "HOT", 3)
    rng = random.Random(width)
    spine = [("u", str(rng.randint(0, 9))) for _ in range(130)]
    built = {c: spine[:rng.randint(0, 130)] + [("a", str(rng.randint(0, 2))) for _ in range(rng.randint(0, 40))] for c in range(25)}
    built |= {c: built[c - 30] for c in range(30, 40)}
    rows = [(c, 0, None, None) for c in built]
    rows += [(c, d + 1, *t) for c, turns in built.items() for d, t in enumerate(turns)]
    told = spark.createDataFrame(rows, "conv_id long, depth long, role string, text string")
    turns = told.select("conv_id", "depth", prefixes.turn_id(told.role, told.text).alias("id"),
                        prefixes.F.length("text").cast("long").alias("size"))
    original = prefixes.before
    monkeypatch.setattr(prefixes, "before", lambda *a: original(*a, run=4))
    got = prefixes.prefix_trie(turns, width).collect()
    assert sorted(map(tuple, got)) == plain_nodes(built)


def test_trie_of_no_conversations(spark, tmp_path):
    assert catalog.op11(spark, table(spark, [], tmp_path)).count() == 0


def test_ordered_hash_streams_over_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(k, n, f"{k}-{n}" if n % 5 else None) for k in (None, 1, 2) for n in range(40)]
        df = spark.createDataFrame(rows, "k long, n long, s string").repartition(5)
        got = {r["k"]: r["h"] for r in ordered_sha256(df, ["k"], ["n"], "s", ",", "h").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {k: sha(",".join(f"{k}-{n}" if n % 5 else "" for n in range(40))) for k in (None, 1, 2)}


# --- repair ------------------------------------------------------------------------------------------------

def plain_plan(symbols):
    """Cheapest first, then by letters: the least (cost, audit) of every (row, state)."""
    done, heap = {}, [(0, "", 0, 0)]
    while heap:
        cost, audit, i, s = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done[i, s] = cost, audit
        after = {0: 2, 1: 2, 2: 3, 3: 2}[s]
        heapq.heappush(heap, (cost + 2, audit + "I", i, after))
        if i < len(symbols):
            c = symbols[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, s))
            if not c.isdigit():
                extra = c.isupper()
                keep = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(c.lower(), {}).get(s)
                if keep is not None:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, keep))
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, after))
    return min(done[len(symbols), s] for s in (0, 3))


def test_plans_are_the_cheapest_and_least(monkeypatch):
    rng = random.Random(3)
    for every in (1, 3, 4096):
        monkeypatch.setattr(repair, "STORED_EVERY", every)
        for _ in range(800):
            alphabet = rng.choice(["suaoSUAO1234", "uaUA", "uu1a", "sS", "u", "oO"])
            symbols = "".join(rng.choice(alphabet) * rng.choice([1, 1, 2, 9]) for _ in range(rng.randint(0, 12)))
            assert repair.plan(symbols) == plain_plan(symbols)


def test_long_runs_by_powers():
    cost, audit = repair.plan("u" * 100_001)
    assert audit.count("R") + audit.count("I") + audit.count("K") + audit.count("D") == len(audit)
    assert cost == 2 * audit.count("R") + 2 * audit.count("I") + 3 * audit.count("D")
    assert cost == plain_cost("u" * 100_001)
    assert repair.ahead("u", 100_001, repair._END)[0] == cost


def plain_cost(symbols):
    v = [0, 4, 2, 0]
    for c in reversed(symbols):
        v = repair.apply(repair.power(c, 0), v)
    return v[0]


def plain_repair(rows):
    ids = {r[0] for r in rows}
    told = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else "".join(x for x in text if x not in ".!?") if d == 2 else text
        told[c] += [(turn is not None, turn or 0, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = []
    for c in ids:
        turns = sorted(told[c])
        seen, symbols, faults = set(), "", []
        for _, _, role, text in turns:
            ink = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "" if ink[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            i = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += {"": i, "truncated": i.upper()}.get(fault, "1234"["suao".index(i)])
        pairs = [(a[2][:1] or "?") + (b[2][:1] or "?") for a, b in zip(turns, turns[1:])]
        stamps = [t for known, t, _, _ in turns if known]
        cost, audit = plain_plan(symbols)
        lines, state, at = [], 0, 0
        for e in audit:
            new, after = ("assistant", 3) if state == 2 else ("user", 2)
            if e == "D":
                at += 1
                continue
            role, text = (turns[at][2:] if e != "I" else (None, ""))
            if e == "K":
                after = {"s": 1, "u": 2, "a": 3}[role[0]]
                lines.append(f"{role}:{text}")
            else:
                lines.append(f"{new}:{text}")
            state, at = after, at + (e != "I")
        out.append((c, max(stamps) - min(stamps) + 1 - len(set(stamps)) if stamps else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines))))
    return sorted(out, key=str)


def test_repair_of_damaged_conversations(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 3)
    rng = random.Random(9)
    rows = []
    for c in [*range(80), -5, None]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, t + 40, None]), rng.choice(["user", "assistant", "system", None, "tool", "", "User", "unknown"]),
                         rng.choice(["a.", "b", "ö🙂!", "", None, "\x0b \n", "c?\t ", "long " * 2000 + ".", " "])))
    rows += rows[:9]
    got = catalog.op13(spark, table(spark, rows, tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == plain_repair(rows)


def test_repaired_turns_are_legal_and_extremes_are_defined(spark):
    rows = [(1, 0, "user", "a.", "x", 1, "y"), (1, 1, "user", "b.", "x", 1, "y"), (2, -2**63, "system", "s.", "x", 1, "y"),
            (2, 2**63 - 1, "assistant", "t", "x", 1, "y")]
    planned, lines = repair.repair(spark.createDataFrame(rows, SCHEMA))
    assert {r["conv_id"]: r["gaps"] for r in planned.collect()} == {1: 0, 2: None}
    roles = [r["role"] for r in lines.filter("conv_id = 1").orderBy("place").collect()]
    assert roles in (["user", "assistant"] * (len(roles) // 2), ["system"] + ["user", "assistant"] * (len(roles) // 2))


def test_repair_of_no_conversations(spark, tmp_path):
    assert catalog.op13(spark, table(spark, [], tmp_path)).count() == 0
    planned, lines = repair.repair(spark.createDataFrame([], SCHEMA))
    assert planned.count() == 0 and lines.count() == 0


def test_a_conversation_without_rows_after_the_damage(spark, tmp_path):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:7".encode()) % 20 == 0)
    got = catalog.op13(spark, table(spark, [(dropped, 7, "user", "a.")], tmp_path)).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_numbered_turns_start_with_null_turns(spark):
    df = spark.createDataFrame([(1, 5, "b", "x", "", 0, ""), (1, None, "z", "y", "", 0, ""), (1, 5, "a", "z", "", 0, "")], SCHEMA)
    got = stage(prefixes.numbered_turns(df), "t").orderBy("position").collect()
    assert [r["size"] for r in got] == [1, 1, 1] and [r["position"] for r in got] == [0, 1, 2]
    assert got[0]["id"] == hashlib.sha256(b"1:zy").digest()[:16] and got[1]["id"] == hashlib.sha256(b"1:az").digest()[:16]
