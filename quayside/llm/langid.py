"""Language identification by mixtures: how much of a document each language wrote.

Each learned language has a table of log probabilities of letter trigrams (bytes of the lower-cased text, with
the space before and after a word). A word's likelihood under a language is the product over its
trigrams, and a document is a mixture: every word comes from one of the languages, with unknown
proportions. Expectation-maximisation estimates the proportions from all words of the document; the
set of languages is the one with the best likelihood less a penalty for each language, found by
taking the least language away as long as that gains.

The tables are counted over all labelled documents, which adds up to one row for each language and
trigram in use, however many documents there are. They are broadcast: ``1 << GRAM_BITS`` floats a language.

A null text and one without a letter are ``und`` with score 0, as is everything if nothing was
learned. Ids may be null or repeat: rows are kept one for one. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import free_name, freeing, small_batches

UNKNOWN = "und"
GRAM_BITS = 17
#: Added to each count of a trigram.
SMOOTHING = 0.1
ITERATIONS = 12
#: Nats a language must gain for each half logarithm of the number of words.
PENALTY = 4.0
#: Bytes whose trigrams are looked up at a time, and of texts whose mixtures are estimated together.
_BYTES_AT_ONCE = 1 << 20
_LETTER = regex.compile(r"\p{L}")
#: ASCII other than letters to spaces.
_TO_WORDS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def _letters(text: str) -> bytes:
    """Lower-cased words with one space or more between them, and one before and after."""
    return b" " + text.lower().encode().translate(_TO_WORDS) + b" "


def _pieces(raw: bytes) -> Iterator[np.ndarray]:
    """Parts of about _BYTES_AT_ONCE that begin and end with a space."""
    at = 0
    while len(raw) - at > _BYTES_AT_ONCE:
        cut = raw.find(b" ", at + _BYTES_AT_ONCE - 1)
        if cut < 0 or cut == len(raw) - 1:
            break
        yield np.frombuffer(raw, np.uint8, cut + 1 - at, at)
        at = cut
    yield np.frombuffer(raw, np.uint8, len(raw) - at, at)


def _grams(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed trigram around each letter, and which of them start a word."""
    wide = part.astype(np.uint32)
    codes = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    inside = part[1:-1] != 32
    first = (part[:-2] == 32)[inside]
    return (codes[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS), first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang")):
            own = counts.setdefault(lang.as_py(), np.zeros(1 << GRAM_BITS, np.int64))
            for part in _pieces(_letters(text.as_py())):
                grams, _ = _grams(part)
                if len(grams) > 5000:
                    own += np.bincount(grams, minlength=len(own))
                else:
                    np.add.at(own, grams, 1)
    for lang, own in counts.items():
        used = np.flatnonzero(own)
        names = pa.array([lang] * len(used), pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array(used), pa.array(own[used])], ["lang", "gram", "n"])


class Model:
    """Log probabilities of trigrams: a row for each trigram, a column for each language."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts + SMOOTHING
        self.table = np.ascontiguousarray(np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))

    def word_scores(self, raw: bytes) -> np.ndarray:
        """Log likelihood of each word (row) under each language (column)."""
        found = []
        for part in _pieces(raw):
            grams, first = _grams(part)
            if len(grams):
                found.append(np.add.reduceat(self.table[grams], np.flatnonzero(first), axis=0))
        return np.concatenate(found) if found else np.zeros((0, len(self.langs)), np.float32)


def learn(docs: DataFrame, text: Column, lang: Column) -> Model | None:
    """The model of all rows with a text and a language; None if there is none."""
    small_batches(docs.sparkSession)
    rows = docs.select(text.cast("string").alias("text"), lang.cast("string").alias("lang"))
    counted = rows.where("text is not null and lang is not null").mapInArrow(freeing(_count), "lang string, gram long, n long")
    found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    if not langs:
        return None
    counts = np.zeros((len(langs), 1 << GRAM_BITS))
    place = {lang: k for k, lang in enumerate(langs)}
    rows_of = np.fromiter((place[x] for x in found["lang"].to_pylist()), np.int64, len(found))
    counts[rows_of, found["gram"].to_numpy()] = found["n"].to_numpy()
    return Model(langs, counts)


def mixtures(scores: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihoods of documents, each of at least one word.

    scores: words by languages, document after document; starts: the first word of each.
    A language outside the chosen set has proportion 0.
    """
    sizes = np.diff(np.append(starts, len(scores)))
    top = scores.max(axis=1, keepdims=True)
    relative = np.exp(scores - top)
    offset = np.add.reduceat(top[:, 0].astype(np.float64), starts)
    active = np.ones((len(starts), scores.shape[1]), dtype=bool)
    shares, fit = _maximise(relative, starts, sizes, active)
    price = PENALTY * 0.5 * np.log(sizes + 1.0)
    # one language alone, against all: no set in between can do better than all at the price of two
    alone = np.add.reduceat(scores.astype(np.float64), starts, axis=0) - offset[:, None]
    best = alone.argmax(axis=1)
    best_alone = alone.max(axis=1)
    single = fit - best_alone <= price
    shares[single] = 0
    shares[single, best[single]] = 1
    fit[single] = best_alone[single]
    open_docs = np.flatnonzero(~single)
    while len(open_docs):
        words = np.concatenate([np.arange(starts[d], starts[d] + sizes[d]) for d in open_docs])
        own_sizes = sizes[open_docs]
        own_starts = np.cumsum(own_sizes) - own_sizes
        tried = active[open_docs]
        least = np.where(tried, shares[open_docs], np.inf).argmin(axis=1)
        tried[np.arange(len(open_docs)), least] = False
        less, less_fit = _maximise(relative[words], own_starts, own_sizes, tried)
        gains = fit[open_docs] - less_fit <= price[open_docs]
        won = open_docs[gains]
        active[won], shares[won], fit[won] = tried[gains], less[gains], less_fit[gains]
        open_docs = won[active[won].sum(axis=1) > 1]
    return shares, fit + offset


def _maximise(relative, starts, sizes, active) -> tuple[np.ndarray, np.ndarray]:
    shares = active / active.sum(axis=1, keepdims=True)
    which = np.repeat(np.arange(len(starts)), sizes)
    for _ in range(ITERATIONS):
        weights = relative * shares.astype(np.float32)[which]
        weights /= np.maximum(weights.sum(axis=1, keepdims=True), 1e-30)
        shares = np.add.reduceat(weights, starts, axis=0, dtype=np.float64) / sizes[:, None]
    total = (relative * shares.astype(np.float32)[which]).sum(axis=1)
    return shares, np.add.reduceat(np.log(np.maximum(total, 1e-30), dtype=np.float64), starts)


def _predict_batch(texts: list[str | None], model: Model | None) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def settle() -> None:
        if held:
            lengths = np.array([len(s) for _, s in held])
            shares, _ = mixtures(np.concatenate([s for _, s in held]), np.cumsum(lengths) - lengths)
            for (k, _), own in zip(held, shares):
                best = int(own.argmax())
                langs[k], scores[k] = model.langs[best], float(min(1.0, own[best]))
            held.clear()

    for k, text in enumerate(texts):
        if model is None or not text or not _LETTER.search(text):
            continue
        raw = _letters(text)
        words = model.word_scores(raw)
        if not len(words):
            continue
        held.append((k, words))
        size += len(raw)
        if size > _BYTES_AT_ONCE:
            settle()
            size = 0
    settle()
    return langs, scores


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """``docs`` without its text, with the predicted language and its share of the document's words.

    A column that has one of the two names already gives way to them.
    """
    kept = [c for c in docs.columns if c.lower() not in {text_col.lower(), lang_as.lower(), score_as.lower()}]
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*kept, F.col(text_col).cast("string").alias(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _predict_batch(batch.column(text_col).to_pylist(), shared.value)
            columns = [*(batch.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, lang_as, score_as])

    schema = rows.select(*kept, F.lit("").alias(lang_as), F.lit(0.0).alias(score_as)).schema
    return rows.mapInArrow(freeing(run), schema)


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language, columns unchanged; texts stay beside their prediction."""
    lang_as, score_as, copy = (free_name(docs, n) for n in ("lang_pred", "score", "text_read"))
    found = predict(docs.withColumn(copy, F.col(text_col)), model, copy, lang_as, score_as)
    return found.where(F.col(lang_as) != UNKNOWN).select(*docs.columns)


def held_out(id_col: str) -> Column:
    """Whether a document is kept from training: a quarter, by the checksum of its id."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2
