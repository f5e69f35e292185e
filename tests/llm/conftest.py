"""Tables with every odd case: nulls, empty and very long texts, repeats, clashing column names."""

import random

import pytest

LONG = "the quick brown fox jumps over a lazy dog again and again " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    rng = random.Random(3)
    base = " ".join(rng.choice(words) for _ in range(80))
    texts = [
        (1, base),
        (2, base),
        (2, base),
        (3, base + " one"),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "12345 !!! ..."),
        (None, "a text without an id, write to a.b@c.example or +1 (555) 010-9999 now"),
        (None, None),
        (8, LONG),
        (9, "Zoë’s café 中文 \U0001f600‍\U0001f680  tabs\tand  spaces here"),
        (10, "a" * 30000),
        (11, "x"),
        (12, "card 4111 1111 1111 1111, ip 10.0.0.1, bad ip 10.0.0.256, token = 'abcdef123456' and AKIA" + "Z9" * 8),
    ]
    rows = [(i, t, "en", "s", 0, 1, "x", 2, "y", [1], f"mongo-{i}", "m", "t", 7, "h", "z", 0.5) for i, t in texts]
    # extra columns whose names the operators use within
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, id int, fp string, component int, spans string, ids array<int>,"
        "_id string, _mark string, _text string, _rows int, _hit string, _spans string, score double",
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def odd_texts(odd_docs):
    return [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]


def key(row):
    return tuple((x is not None, x) for x in row)
