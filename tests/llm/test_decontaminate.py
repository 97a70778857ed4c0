"""Benchmark decontamination against a plain search of word windows."""

import hashlib
import random
import re

import pytest

from tabulon.llm import catalog, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        for i in range(max(len(words) - width + 1, 1) if words else 0):
            windows.setdefault(tuple(words[i:i + width]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, ids = WORD.findall(lowered(text)), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    ids |= windows[tuple(words[i:i + n])]
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((doc, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    vocabulary = ["Alpha", "beta", "gamma1", "Ö", "öl", "word", "naïve", "x", "日本", "42"]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(some(rng.choice([3, 9, 10, 11, 25])))) for i in range(30)]
    items += [(7, "second text of seven, quite another one: it is not of the words above"), (None, " ".join(some(12))), (40, None), (41, "..."),
              (42, "Solo-Item"), (43, items[3][1]), items[3]]
    docs = []
    for d in range(60):
        parts = some(rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice([" - ", "\n", "?!", "\x00"])] + [(rng.choice(items)[1] or "").upper()] + some(3)
        docs.append((d, rng.choice([" ", "  ", ", ", "_"]).join(parts)))
    docs += [(100, None), (101, ""), (102, "..."), (103, "solo item"), (103, "solo item"), (None, "SOLO_ITEM"), (104, "soloitem solo"),
             (105, "ÄÖ " * 50_000 + items[5][1]), (106, "solo item solo item")]
    return docs, items


def tables(spark, docs, items, path):
    spark.createDataFrame([(*d, "x", 5) for d in docs], "doc_id long, text string, items string, n_hit int").repartition(3).write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").repartition(2).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.mark.parametrize("limit", [3_000_000, 300])
def test_hits_of_one_or_many_automata(spark, tmp_path, monkeypatch, limit):
    docs, items = corpus()
    original = decontaminate.decontaminate
    monkeypatch.setattr(catalog.decontaminate, "decontaminate", lambda d, i: original(d, i, automaton_bytes=limit))
    got = catalog.op12(spark, tables(spark, docs, items, tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == plain(docs, items)


def test_spans_lead_back_to_the_original_text(spark):
    docs = [(1, "ö🙂 Say: THE Answer,is 42!  end"), (2, "nothing")]
    items = [(5, "what is asked", "the answer is 42")]
    df = spark.createDataFrame([(*d, 9) for d in docs], "doc_id long, text string, spans int")
    found = decontaminate.decontaminate(df, spark.createDataFrame(items, "item_id long, question string, answer string"), ["question", "answer"])
    got = {r["doc_id"]: r for r in found.collect()}
    (start, end), = got[1]["spans"]
    assert docs[0][1][start:end] == "THE Answer,is 42" and got[1]["items"] == ["5"] and got[1]["n_hit"] == 4
    assert got[2]["spans"] == [] and got[2]["text"] == "nothing" and found.columns == ["doc_id", "text", "n_words", "n_hit", "items", "spans"]


def test_without_documents_or_items(spark, tmp_path):
    docs, items = corpus()
    none = [d for d in plain(docs, [])]
    got = catalog.op12(spark, tables(spark, docs, [(1, None), (2, "")], tmp_path / "a")).collect()
    assert sorted(map(tuple, got), key=str) == none
    assert sorted(map(tuple, catalog.op12(spark, tables(spark, docs, [], tmp_path / "b")).collect()), key=str) == none
    assert catalog.op12(spark, tables(spark, [], items, tmp_path / "c")).count() == 0
