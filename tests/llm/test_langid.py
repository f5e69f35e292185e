import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import langid

SYLLABLES = {"aa": ["ka", "to", "mi", "re"], "bb": ["sch", "ung", "lich", "ein"], "cc": ["eau", "oux", "tion", "ville"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(2, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(k, text(rng, lang, rng.randint(5, 60)), lang) for k in range(240) for lang in [rng.choice(list(SYLLABLES))]]
    return spark.createDataFrame([*rows, (900, None, "aa"), (901, "kato", None)], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(labelled):
    return langid.learn(labelled.where(~langid.held_out("doc_id")), F.col("text"), F.col("lang"))


def test_held_out_accuracy(labelled, model):
    found = langid.predict(labelled.withColumn("mine", F.col("lang")).drop("lang"), model)
    held = found.where(langid.held_out("doc_id") & F.col("mine").isNotNull() & (F.col("doc_id") < 900))
    right, every = held.agg(F.sum((F.col("mine") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert every > 30 and right == every


def test_mixture_shares(model):
    rng = random.Random(5)
    mixed = text(rng, "aa", 300) + " " + text(rng, "cc", 100)
    langs, scores = langid._predict_batch([mixed], model)
    assert langs == ["aa"] and scores[0] == pytest.approx(0.75, abs=0.03)
    words = model.word_scores(langid._letters(mixed))
    shares, _ = langid.mixtures(words, np.array([0]))
    assert shares[0][1] == 0  # the third language is not in the set


def test_pieces_of_long_texts_make_no_difference(model, monkeypatch):
    raw = langid._letters(text(random.Random(2), "bb", 2000))
    whole = model.word_scores(raw)
    monkeypatch.setattr(langid, "_BYTES_AT_ONCE", 64)
    assert np.allclose(model.word_scores(raw), whole, atol=1e-3)


def test_odd(odd_docs, odd_texts, model):
    found = langid.predict(odd_docs.select("doc_id", "text", "fp"), model).collect()
    assert len(found) == len(odd_texts)
    for row in found:
        if row.doc_id in (4, 5, 6, 7):
            assert (row.lang_pred, row.score) == (langid.UNKNOWN, 0.0)
        elif row.doc_id is not None:
            assert row.lang_pred in SYLLABLES and 0 < row.score <= 1
    kept = langid.with_language(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert sorted({r.doc_id for r in kept.collect()} - {None}) == [1, 2, 3, 8, 9, 10, 11, 12]


def test_clash_and_nothing_learned(odd_docs, no_docs):
    assert langid.learn(no_docs, F.col("text"), F.col("lang")) is None
    assert {r.lang_pred for r in langid.predict(odd_docs, None).collect()} == {langid.UNKNOWN}
    # the table has a score of its own, which gives way
    found = langid.predict(odd_docs, None)
    assert found.columns.count("score") == 1 and {r.score for r in found.collect()} == {0.0}
    assert langid.predict(no_docs, None).count() == 0
