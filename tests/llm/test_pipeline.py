"""The pipeline's stages, each on what the one before kept, against plain Python."""

import tracemalloc
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from test_native import plain_spans, plain_targets
from test_text import WORDS, plain_classes
from tests_llm_languages import make

from tabulon.llm import catalog, langid, secrets
from tabulon.llm.common import chunks, stage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _doc int, taken string"


@pytest.fixture(scope="module")
def documents():
    rows = [(i, t, lang, f"s{i % 5}" if i % 11 else None, len(t), i, "x") for i, t, lang, _ in make()]
    long_one = " ".join(t for _, t, *_ in rows[:120])
    rows += [(500, rows[30][1], "aa", "s9", 1, 1, None), (None, rows[30][1], "aa", "s9", 1, 1, None), (501, None, None, None, None, None, None),
             (502, "", None, "s1", 0, 0, ""), (503, "12 .. 34", "aa", "s1", 8, 0, ""), (504, long_one, None, "s2", 5, 0, ""),
             (505, long_one + " token=abcdefgh1 secret: zz", "bb", None, 5, 0, ""), (506, "tore " * 30 + "AKIA" + "Q7" * 10, "aa", "s1", 5, 0, "")]
    return rows + [rows[3], rows[3], rows[8]]


def test_every_stage(spark, documents):
    docs = spark.createDataFrame(documents, SCHEMA).repartition(3)
    state = [tuple(r) for r in docs.collect()]
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, ""), f"test-{name}")
        got = [tuple(r) for r in out.collect()]
        if name != "pack":
            assert out.columns == docs.columns
        if name == "language":
            assert Counter(got) == Counter(r for r in state if r[1] and any(c.isalpha() for c in r[1]))
        elif name == "near_dedup":
            want = Counter()
            for g in plain_classes([(r[0], r[1]) for r in state]):
                want[min((state[i] for i in g), key=lambda r: (r[0] is None, r[0] or 0))[0]] += 1
            assert Counter(r[0] for r in got) == want and not Counter(got) - Counter(state)
        elif name == "secret_scan":
            assert len(got) == len(state) and not any(plain_spans(r[1]) for r in got)
            hit = {r[0] for r in state if plain_spans(r[1])}
            assert hit >= {505, 506} - ({505} - {r[0] for r in state}) and hit
            assert Counter(r for r in got if r[0] not in hit) == Counter(r for r in state if r[0] not in hit)
            assert all(secrets.MASK in r[1] and r[4] == len(r[1]) for r in got if r[0] in hit)
        elif name == "mixture":
            assert not set(got) - set(state) and max(Counter(got).values()) <= 2 * max(Counter(state).values())
            sizes = Counter()
            for r in got:
                sizes["out"] += len(WORDS.findall(r[1]))
            total = sum(len(WORDS.findall(r[1])) for r in state)
            assert 0.8 * total < sizes["out"] < 2 * total
        else:
            from tokenizers import Tokenizer

            plain = Tokenizer.from_file(catalog.tokenizer("byte_bpe_50k.json"))
            want = sum(len(plain.encode(r[1], add_special_tokens=False).ids) + 1 for r in state)
            assert int(np.sum([r["length"] for r in out.collect()])) == want
        docs, state = out, got


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, ""), f"empty-{name}")
        assert docs.count() == 0


def test_mixture_keeps_each_sources_words(spark):
    rows, n = [], 0
    for k in range(20):
        for i in range(40 if k == 1 else 20):  # s01: ten blocks a document, a fifth of all words, a ratio near 0.3
            size = 2560 + i if k == 1 else 700 + 30 * i + 7 * k
            rows.append((n := n + 1, f"t{n} " + "w " * (size - 1), "aa", f"s{k:02d}", size, 0, ""))
    rows += [rows[0]] * 3 + [(None, " .", None, "s01", 1, 0, "")] * 2 + [(None, f"n{i} " + "w " * 99, None, None, 1, 0, "") for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = [tuple(r) for r in corpus_pipeline.mixture(spark, docs.repartition(3), "").collect()]
    sizes, got, longest = Counter(), Counter(), Counter()
    for r in rows:
        size = len(WORDS.findall(r[1]))
        sizes[r[3]] += size
        longest[r[3]] = max(longest[r[3]], size)
    for r in out:
        got[r[3]] += len(WORDS.findall(r[1]))
    want = plain_targets(sizes)
    assert want["s01"] < 0.4 * sizes["s01"]
    for s in sizes:
        assert abs(got[s] - want[s]) <= 1.1 * longest[s] + 0.01 * want[s], (s, got[s], want[s], sizes[s])
    kept = len({r[0] for r in out if r[3] == "s01" and r[0]})
    assert abs(kept - 40 * want["s01"] / sizes["s01"]) <= 2
    assert not set(out) - set(rows) and Counter(out)[rows[-31]] == 2
    assert Counter(out) == Counter(tuple(r) for r in corpus_pipeline.mixture(spark, docs.repartition(5), "").collect())


def test_language_rejects_what_no_label_taught(spark, documents):
    foreign = [(900, "Съешь ещё этих мягких французских булок, да выпей же чаю", None, "s1", 1, 0, ""),
               (901, "これは 日本語の 文章です まだ 習って いません", None, "s1", 1, 0, ""),
               (902, "whiff glyph nymph jabbing quickly wizard foxes vexed puzzling", "", None, 1, 0, "")]
    mixed = (903, documents[0][1] + " " + documents[1][1] + " 12 булок 99 password=0a1b2c3d4e", None, "s1", 1, 0, "")
    rows = documents + [(*r[:2], None, *r[3:]) for r in foreign] + [mixed]
    out = corpus_pipeline.language(spark, spark.createDataFrame(rows, SCHEMA), "")
    lettered = [r for r in documents if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter(tuple(r) for r in out.collect()) == Counter([*lettered, mixed])
    unlabelled = [(*r[:2], None, *r[3:]) for r in documents + foreign]
    out = corpus_pipeline.language(spark, spark.createDataFrame(unlabelled, SCHEMA), "")
    assert Counter(tuple(r) for r in out.collect()) == Counter((*r[:2], None, *r[3:]) for r in lettered + foreign)


def test_language_needs_little_memory_a_task():
    """Trigrams of a batch of long texts are made in pieces: a task holds some 100 bytes for each byte of a piece."""
    text = " ".join(t for _, t, _, _ in make())
    texts = pa.array([text[:50_000]] * 80)
    model = langid.LanguageModel(("aa", "bb"), np.log(np.full((langid.CELLS, 2), 1 / langid.CELLS)))
    tracemalloc.start()
    for part in chunks(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), langid.TEXT_BYTES):
        langid.predict(part["text"], model)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60_000_000


def test_language_carries_a_text_once(spark, tmp_path, monkeypatch):
    sent = []
    found = langid.identify
    monkeypatch.setattr(langid, "identify", lambda docs, *a: sent.append(docs.schema) or found(docs, *a))
    rows = spark.createDataFrame(make(), "doc_id long, text string, lang string, n_chars int").select("lang", "text", "n_chars", "doc_id")
    kept = corpus_pipeline.language(spark, rows, str(tmp_path))
    assert kept.schema == rows.schema and sent[0]["_doc"].dataType.names == ["lang", "n_chars", "doc_id"]
    assert Counter(kept.collect()) == Counter(rows.collect())
