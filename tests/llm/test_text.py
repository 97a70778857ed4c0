"""Operators on texts against plain Python: repeats, near-duplicates, token counts, packing, language."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabulon.llm import catalog, langid, minhash, packing, substring, tokens

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_repeats(rows, window):
    words = [WORDS.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def documents(texts):
    passage, long_one = texts(60, 1), texts(9000, 2)
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, " ".join(texts(80, 3))), (4, " ".join(long_one)), (5, " ".join(texts(34, 4)))]
    for i in range(6, 30):
        body = texts(50, i)
        at = i % 40
        rows.append((i, ("\n" if i % 2 else "  ").join([*body[:at], *(passage if i % 3 else []), *body[at:]])))
    rows += [(40, " ".join(texts(70, 40)))] * 3 + [(41, "ka " * 90), (42, " ".join(long_one[:300] + ["x"] + long_one[300:700])),
             (43, "a\x1fb ".join(texts(50, 43))), (None, None), (44, " ".join(texts(36, 44) * 2))]
    return rows


@pytest.mark.parametrize("options", [{}, {"hot_words": 150, "words_per_bucket": 900}])
def test_repeats_are_removed_exactly(spark, documents, options):
    df = spark.createDataFrame([(a, b, 1) for a, b in documents], "doc_id long, text string, ranges int").repartition(3)
    if options:  # the bar of a ten-thousandth is below these counts, so hot minimisers occur
        counts = substring.count_runs(df.select("text"), 35, substring.MINIMISER)
        assert counts.filter("n > 150").count() > 0
    got = substring.remove_repeats(df, **options).collect()
    assert Counter(tuple(r["doc_id n_words n_removed kept_sha256".split()[k]] for k in range(4)) for r in got) == Counter(
        plain_repeats(documents, 35))
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)
    assert substring.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [10 ** 12, 100])
def test_long_runs_are_cut_and_ranges_joined_without_changing_a_word(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(substring, "RUN_WINDOWS", 7)
    monkeypatch.setattr(substring, "_BLOCK", 50)
    some = texts(200, 3)
    rows = [(1, "a " * 400), (2, " ".join(some) + " b" * 90), (3, "x " + " ".join(some[20:80])), (4, "c " * 35), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    content = df.withColumn("content", F.unhex(F.md5("text")))
    got = substring.remove_repeats(df, hot_words=hot, words_per_bucket=500).collect()
    assert Counter(tuple(r["doc_id n_words n_removed kept_sha256".split()[k]] for k in range(4)) for r in got) == Counter(
        plain_repeats(rows, 35))
    ranges = substring.repeated_passages(content, hot_words=hot, words_per_bucket=500).collect()
    assert all(len(r["ranges"]) < 80 for r in ranges)


def test_a_text_of_one_word_is_no_group_and_no_long_list(spark):
    import time

    df = spark.createDataFrame([(1, "word " * 1_000_000), (2, "other text")], "doc_id long, text string")
    start = time.time()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.remove_repeats(df).collect()}
    assert time.time() - start < 40
    assert got == {1: (1_000_000, 1_000_000, ""), 2: (2, 0, "other text")}


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring, "run_hashes", lambda words, n, base: np.zeros(max(0, len(words) - n + 1), np.uint64))
    line, number = substring.repeated_windows(pa.array(["a b c", "d a b", "x y"], pa.large_string()), 2)
    assert sorted(zip(line.tolist(), number.tolist())) == [(0, 0), (1, 1)]


def bag(text):
    w = WORDS.findall(text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def overlap(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def plain_classes(rows):
    bags, root = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and overlap(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return {frozenset(g) for g in groups.values()}


@pytest.fixture(scope="module")
def copies(texts):
    rows = [(i, " ".join(texts(60 + i, 100 + i))) for i in range(20)]
    base = texts(300, 7)
    for i in range(60):  # a large group of near copies, each with edits of its own
        own, rng = list(base), random.Random(i)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(300)] = f"edit{i}"
        rows.append((100 + i, " ".join(own)))
    chain = texts(200, 8)
    for i in range(12):  # a chain: neighbours are alike, ends are not
        rows.append((200 + i, " ".join(texts(8 * i, 300) + chain[8 * i:])))
    rows += [(300, "one two three"), (301, "one  two\nthree"), (302, "three two one"), (303, None), (304, ""), (304, ""),
             (305, "ha " * 500), (306, "ha " * 520), (307, "ha " * 100), (310, rows[0][1]), (310, rows[0][1])]
    return rows


def test_near_duplicate_classes_match_all_pairs(spark, copies, tmp_path):
    spark.createDataFrame([(a, b, 0) for a, b in copies], "doc_id long, text string, class int").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = catalog.op2(spark, str(tmp_path)).collect()
    assert len(got) == len(copies)
    want = Counter()
    for g in plain_classes(copies):
        ids = [copies[i][0] for i in g]
        want.update((copies[i][0], min(ids), len(g)) for i in g)
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == want
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_blocks_find_every_link(spark, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string")
    found = {r["doc_id"]: r["class"] for r in minhash.near_duplicates(df, pivots=()).collect()}
    for g in plain_classes([r for r in copies if r[1]]):
        ids = {[r for r in copies if r[1]][i][0] for i in g}
        assert len({bytes(found[i]) for i in ids}) == 1
    assert len({bytes(c) for c in found.values() if c}) == len(plain_classes([r for r in copies if r[1]]))


def test_signatures_estimate_the_weighted_similarity():
    rng = random.Random(3)
    for share in (0.3, 0.6, 0.9):
        a = Counter({i: rng.choice([1, 1, 2, 7, 40]) for i in range(60)})
        b = Counter({i if rng.random() < share else 1000 + i: n + rng.choice([0, 0, 3]) for i, n in a.items()})

        class Two:
            rows = 2
            value = np.array([*a, *b], dtype=np.uint64) * np.uint64(2654435761)
            times = np.array([*a.values(), *b.values()])
            doc = np.array([0] * len(a) + [1] * len(b))

        marks = minhash.signatures(Two, 4096)
        assert (marks[0] == marks[1]).mean() == pytest.approx(overlap(a, b), abs=0.03)


def test_counts_equal_the_unigram_tokenizer(spark, texts):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = catalog.tokenizer("piece_bpe_32k.model")
    scores = tokens.piece_scores(path)
    vocabulary = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), *scores.items()]
    plain = Tokenizer(models.Unigram([(p, s if i else 0.0) for i, (p, s) in enumerate(vocabulary)], 0, byte_fallback=True))
    plain.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    rows = [" ".join(texts(n, n)) for n in (1, 5, 40, 300)] + [
        "  two  spaces   here ", "\n\nline\n\n\nbreaks\t\ttabs", "日本語のテキスト と English", "🙂🙂🙂 naïve ﬀ", "aaaaaaaaaaaaaaaaaaaaaaaa",
        "x" * 5000, "A.B,C;D", "▁ literal ▁▁mark", "ÿþ\x00\x01 end", "The quick brown fox jumps over the lazy dog.", " ", "é" * 50]
    want = [len(plain.encode(t, add_special_tokens=False).ids) for t in rows]
    assert tokens.UnigramCounter(scores).count(rows).tolist() == want
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate([*rows, None, "", rows[0]])], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(df, path).collect()}
    assert [got[i] for i in range(len(rows) + 3)] == [*want, 0, 0, want[0]]
    assert tokens.count_tokens(df.limit(0), path).count() == 0


@pytest.mark.parametrize("together", [0, 10 ** 9])
def test_texts_without_spaces_and_both_ways_to_score(monkeypatch, together):
    import time

    from tokenizers import Tokenizer, models, pre_tokenizers

    scores = tokens.piece_scores(catalog.tokenizer("piece_bpe_32k.model"))
    vocabulary = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), *scores.items()]
    plain = Tokenizer(models.Unigram([(p, s if i else 0.0) for i, (p, s) in enumerate(vocabulary)], 0, byte_fallback=True))
    plain.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    draw = random.Random(4)
    kinds = ["abcdefghij", "abc \u00e9\u00df\n", "".join(map(chr, range(0x4E00, 0x5200))), "\U0001F642xy \u65e5\u672c"]
    rows = ["".join(draw.choices(k, k=n)) for k in kinds for n in (1, 3, 17, 400)]
    monkeypatch.setattr(tokens, "TOGETHER", together)
    counter = tokens.UnigramCounter(scores)
    assert counter.count(rows).tolist() == [len(plain.encode(t, add_special_tokens=False).ids) for t in rows]
    if together:
        long = ["".join(draw.choices(kinds[0], k=1_000_000)), "".join(draw.choices(kinds[2], k=350_000))]
        start = time.time()
        got = counter.count(long).tolist()
        assert time.time() - start < 20
        monkeypatch.setattr(tokens, "KEPT_CHARACTERS", 0)
        assert got[1] == counter.count([long[1]])[0] and not counter.seen


def test_the_registered_count_query_equals_a_plain_unigram_model(spark, texts, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    rows = [*enumerate([*texts(60, 9), "a" * 3000, "", None]), (7, "again"), (7, "again"), (None, "no id")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    scores = tokens.piece_scores(catalog.tokenizer("piece_bpe_32k.model"))
    vocabulary = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), *scores.items()]
    plain = Tokenizer(models.Unigram([(p, s if i else 0.0) for i, (p, s) in enumerate(vocabulary)], 0, byte_fallback=True))
    plain.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    got = Counter((r["doc_id"], r["n_tokens"]) for r in catalog.QUERIES["op8_viterbi_counts"](spark, str(tmp_path)).collect())
    assert got == Counter((d, len(plain.encode(t, add_special_tokens=False).ids) if t else 0) for d, t in rows)


def test_ties_go_to_the_longest_last_piece():
    from tokenizers import Tokenizer, models

    for pieces in ({"a": -1.0, "b": -1.0, "ab": -2.0, "c": -1.0, "bc": -2.0, "abc": -3.0, "▁": -1.0},
                   {"a": -1.5, "aa": -3.0, "aaa": -4.5, "▁": 0.0, "▁a": -1.5}, {"▁": -1.0, "a": -2.0, "▁a▁": -4.0}):
        plain = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items()], 0))
        low = min(0.0, *pieces.values())
        for text in ("abc", "aaaaaaa", "abcabcbca", "a a a", "bca"):
            if not {*text} - {" "} <= {*pieces}:
                continue
            marked = "▁" + text.replace(" ", "▁")
            assert tokens.UnigramCounter(pieces, low).count([text])[0] == len(plain.encode(marked).ids), (pieces, text)


def test_packing_round_trip(spark, texts, documents, tmp_path):
    rows = documents + [(500 + i, " ".join(texts(10 + 13 * i, i))) for i in range(120)] + [
        (900, "日本語 " * 20), (901, "x <|endoftext|> y"), (902, " ​ nbsp ǆ Ω"), *[(903, "same text")] * 50]
    spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, start int").repartition(4).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = catalog.op7(spark, str(tmp_path)).collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(catalog.tokenizer("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for a in range(0, len(ids), 2048):
            part = ids[a:a + 2048]
            want[doc_id, a, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
    assert sorted(held) == list(range(len(held)))
    assert total / (2048 * len(held)) > 0.95
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), catalog.tokenizer("byte_bpe_50k.json")).count() == 0


def test_both_encoders_agree(texts):
    json, ranks = catalog.tokenizer("byte_bpe_50k.json"), catalog.tokenizer("byte_bpe_50k.tiktoken")
    rng = random.Random(1)
    latin = [chr(c) for c in [*range(128), *range(0xA1, 0x250), *range(0x2010, 0x2028)]]
    rows = [" ".join(texts(200, 1)), *("".join(rng.choice(latin) for _ in range(300)) for _ in range(300)), *latin,
            *(c + " a1" + c + "  " + c + c for c in latin)]
    for a, b in zip(packing.encode(rows, json), packing.encode(rows, json, ranks)):
        assert a.tolist() == b.tolist()


def test_patterns_use_the_histogram_once():
    rng = random.Random(4)
    for histogram in ({v: rng.randint(0, 30) for v in range(1, 64)}, {40: 1000, 23: 5}, {1: 700}, {64 - 1: 3}, {}):
        used = Counter()
        for parts, repeats in packing.plan_patterns(histogram, 64):
            assert repeats > 0 and sum(v * m for v, m in parts) <= 64
            for v, m in parts:
                used[v] += m * repeats
        assert used == Counter({v: n for v, n in histogram.items() if n})


@pytest.fixture(scope="module")
def languages():
    from tests_llm_languages import make

    return make()


def test_language_accuracy_and_cases(spark, languages, tmp_path):
    rows = languages + [(9001, None, "xx", 0), (9002, "", None, 0), (9003, "12 34 !!", "aa", 0), (9004, "qzx", None, 0), (None, "ka to", None, 0),
                        languages[0], languages[0]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = catalog.op4(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in languages}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in (9001, 9002, 9003)) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 20 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit_languages(empty)
    assert langid.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).collect()} == {"und"}


def plain_mixture(like, sweeps=200):
    share = np.full(like.shape[1], 1 / like.shape[1])
    for _ in range(sweeps):
        part = like * share
        share = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
    return share


def test_mixture_shares(languages):
    rng = np.random.default_rng(2)
    like = rng.random((400, 3)) * 0.2
    like[:240, 0] += 1
    like[240:, 1] += 1
    share, chosen = langid.mixtures(like / like.max(axis=1, keepdims=True), np.zeros(400, np.int64), 1)
    assert share[0, :2] == pytest.approx(plain_mixture(like)[:2], abs=0.02) and chosen[0].tolist() == [True, True, False]
    alone, chosen = langid.mixtures(like[:240] / like[:240].max(axis=1, keepdims=True), np.zeros(240, np.int64), 1)
    assert chosen[0].tolist() == [True, False, False] and alone[0, 0] == 1
