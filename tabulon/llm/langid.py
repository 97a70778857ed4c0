"""Language identification by mixtures: expectation-maximisation over n-gram likelihoods, sets by penalised likelihood."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.llm.common import Words, chunks, mix

CELLS = 1 << 16
SMOOTHING = 0.05
UNDETERMINED = "und"
KNOWN_SHARE = 1 / 2
#: Bytes of text that a task holds as trigrams at a time; each takes about 100 bytes of arrays meanwhile.
TEXT_BYTES = 400_000


@dataclass(frozen=True)
class LanguageModel:
    """Log-likelihoods of hashed byte trigrams (cells x languages)."""

    languages: tuple[str, ...]
    log_p: np.ndarray


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each trigram of the words, and where each word's first one is.

    A word of n bytes has n of them: each byte with the two before it, a word
    starting after a mark. Bytes come from whole lower-case texts, in UTF-8.
    """
    size = words.end - words.start
    at = np.cumsum(size) - size
    total = int(size.sum())
    inside = np.arange(total, dtype=np.int64)
    where = inside + np.repeat(words.start - at, size)
    byte = words.data[where].astype(np.uint32)
    begin = np.repeat(at, size)
    one = np.where(inside - 1 >= begin, np.concatenate([[0], byte[:-1]]), 0)
    two = np.where(inside - 2 >= begin, np.concatenate([[0, 0], byte[:-2]])[:total], 0)
    key = (two.astype(np.uint64) << np.uint64(16)) | (one.astype(np.uint64) << np.uint64(8)) | byte.astype(np.uint64)
    return (mix(key) & np.uint64(CELLS - 1)).astype(np.int64), at


def lowered(text: Column) -> Column:
    return F.lower(text)


def fit_languages(labelled: DataFrame, docs_per_language: int = 2000) -> LanguageModel:
    """Fit on ``text`` and ``lang`` of a bounded sample: at most ``docs_per_language`` doc_ids of each language.

    The sample is the ids with the smallest hashes, so reruns agree. Rows whose
    text or lang is null are left out. Counts are summed by Spark; the driver
    gets ``CELLS`` counts a language.
    """
    usable = labelled.filter("text is not null and lang is not null")
    ids = usable.select("doc_id", "lang").filter("doc_id is not null").distinct()
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= docs_per_language)
    # Proven bound: docs_per_language rows a language.
    sample = usable.join(F.broadcast(chosen.drop("_n")), ["doc_id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part in chunks(batches, TEXT_BYTES):
            cells, _ = _grams(words := Words(part["text"]))
            names, codes = np.unique(np.array(part["lang"].to_pylist(), dtype=object).astype(str), return_inverse=True)
            owner = np.repeat(codes[words.doc], words.end - words.start)
            for k, name in enumerate(names):
                total.setdefault(name, np.zeros(CELLS, dtype=np.int64))
                total[name] += np.bincount(cells[owner == k], minlength=CELLS)
        for name, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "cell", "n"])

    rows = sample.select("lang", lowered(F.col("text")).alias("text")).mapInArrow(count, "lang string, cell long, n long")
    table = rows.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    seen = {r["lang"] for r in usable.select("lang").distinct().collect()}  # languages whose texts have no word count too
    languages = tuple(sorted(seen))
    counts = np.zeros((CELLS, max(len(languages), 1)))
    for k, name in enumerate(languages):
        own = table[table["lang"] == name]
        counts[own["cell"].to_numpy(dtype=np.int64), k] = own["n"].to_numpy()
    p = (counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * CELLS)
    return LanguageModel(languages, np.log(p))


def mixtures(likelihood: np.ndarray, doc: np.ndarray, rows: int, sweeps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (rows x languages) and the selected set of each document.

    ``likelihood`` holds per word and language its likelihood, scaled by the
    word's best one; ``doc`` its document, ascending. The full mixture is fitted
    by expectation-maximisation; then sets grow in the order of its proportions,
    each refitted, as long as the log-likelihood less half of log(words) for each
    further language improves.
    """
    n_lang = likelihood.shape[1]
    words = np.bincount(doc, minlength=rows)

    def fit(allowed: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions over the allowed languages of the wanted documents, and their log-likelihoods."""
        share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
        logs = np.zeros(rows)
        active = wanted & (words > 0)
        for _ in range(sweeps):
            mask = active[doc]
            own, like = doc[mask], likelihood[mask]
            if not len(own):
                break
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            ids = own[first]
            part = like * share[own]
            whole = part.sum(axis=1)
            logs[ids] = np.add.reduceat(np.log(np.maximum(whole, 1e-300)), first)
            part /= np.maximum(whole, 1e-300)[:, None]
            new = np.add.reduceat(part, first, axis=0) / words[ids][:, None]
            change = np.abs(new - share[ids]).max(axis=1)
            share[ids] = new
            active = np.zeros(rows, dtype=bool)
            active[ids[change > 1e-3]] = True
        return share, logs

    everyone = np.ones(rows, dtype=bool)
    full, _ = fit(np.ones((rows, n_lang)), everyone)
    order = np.argsort(-full, axis=1, kind="stable")
    allowed = np.zeros((rows, n_lang))
    allowed[np.arange(rows), order[:, 0]] = 1
    share, logs = fit(allowed, everyone)
    going = everyone & (words > 0)
    for k in range(1, n_lang):
        going = going & (full[np.arange(rows), order[:, k]] > 1e-3)
        if not going.any():
            break
        more = allowed.copy()
        more[np.arange(rows), order[:, k]] = 1
        tried, got = fit(more, going)
        going = going & (got - 0.5 * np.log(np.maximum(words, 1)) > logs)
        share[going], logs[going], allowed[going] = tried[going], got[going], more[going]
    return share, allowed.astype(bool)


def predict(texts: pa.Array, model: LanguageModel) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """Per lower-case text the language with the largest share, that share, and all shares."""
    words = Words(texts)
    rows, n_lang = words.rows, len(model.languages)
    cells, at = _grams(words)
    logs = np.empty((len(at), n_lang))
    for k in range(n_lang if len(at) else 0):
        logs[:, k] = np.add.reduceat(model.log_p[cells, k], at)
    best = logs.max(axis=1, keepdims=True) if len(at) else logs
    share, _ = mixtures(np.exp(np.maximum(logs - best, -60.0)), words.doc, rows)
    top = share.argmax(axis=1)
    return [model.languages[k] for k in top], share[np.arange(rows), top], share


def floors(model: LanguageModel) -> np.ndarray:
    """Per language the log-likelihood a byte that its words reach: halfway from what its own texts have to that of chance.

    Its own texts have the negative entropy of its cells, chance has 1 / ``CELLS`` for each; a language without
    any learned word has no floor (infinite).
    """
    own, chance = (np.exp(model.log_p) * model.log_p).sum(axis=0), -np.log(CELLS)
    return np.where(own > chance + 1e-6, (own + chance) / 2, np.inf)


def known_share(texts: pa.Array, model: LanguageModel) -> np.ndarray:
    """Per lower-case text the share of its words with letters that reach the floor of a learned language.

    A letter is a to z or any byte beyond ASCII. 1 where there is no such word, or nothing was learned.
    """
    words, least = Words(texts), floors(model)
    cells, at = _grams(words)
    letter = np.concatenate([[0], np.cumsum(((words.data >= 97) & (words.data <= 122)) | (words.data >= 128))])
    lettered = letter[words.end] > letter[words.start]
    if not lettered.any() or not len(model.languages) or np.isinf(least).all():
        return np.ones(words.rows)
    size, reached = words.end - words.start, np.zeros(len(at), dtype=bool)
    for k in range(len(model.languages)):
        reached |= np.add.reduceat(model.log_p[cells, k], at) >= least[k] * size
    total = np.bincount(words.doc, lettered, words.rows)
    return np.where(total > 0, np.bincount(words.doc, lettered & reached, words.rows) / np.maximum(total, 1), 1.0)


def identify(docs: DataFrame, model: LanguageModel, known: float = 0.0) -> DataFrame:
    """Add ``lang_pred``, ``score`` (its share of the words) and ``lang_shares`` (of every selected language).

    Only ``text`` is read. ``und``, score 0, stands for a text that is null or
    has no letter, and for every text if no language was learned; also for a text
    of whose words less than ``known`` reach a learned language's floor
    (``known_share``). Whole texts; rows stay where they are; input columns with the result's names are replaced.
    """
    added = ["lang_pred", "score", "lang_shares"]
    rest = docs.drop(*added)
    kept = rest.schema.fields
    letters = F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False))
    held = docs.sparkSession.sparkContext.broadcast(model)
    inner = rest.select(F.struct("*").alias("row"), lowered(F.col("text")).alias("text"), letters.alias("letters"))
    shares = pa.map_(pa.string(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = held.value
        for part in chunks(batches, TEXT_BYTES):
            if learned.languages:
                names, scores, share = predict(part["text"], learned)
            else:
                names, scores, share = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows), np.zeros((part.num_rows, 0))
            names, scores, maps = list(names), scores.copy(), []
            told = part["letters"].to_numpy(zero_copy_only=False)
            if known > 0:
                told = told & (known_share(part["text"], learned) >= known)
            for i, ok in enumerate(told):
                if not ok:
                    names[i], scores[i] = UNDETERMINED, 0.0
                maps.append([(x, float(s)) for x, s in zip(learned.languages, share[i]) if s > 1e-3] if ok else [])
            yield pa.RecordBatch.from_arrays(
                [part["row"], pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1)), pa.array(maps, shares)],
                names=["row", *added])

    schema = T.StructType([
        T.StructField("row", T.StructType(kept)), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("lang_shares", T.MapType(T.StringType(), T.DoubleType()))])
    return inner.mapInArrow(run, schema).select("row.*", *added)
