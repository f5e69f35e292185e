import os
import random

import pytest

from quayside.llm import secrets

SF_DIR = "/root/testdata/sf0.01"


def test_base_spans():
    text = "PassWord : \"hunter22\" é token=abc AKIA" + "A1" * 8 + " AKIASHORT " + "deadbeef" * 3 + " api_key='x.y/z+1=' ſecret=abcdefgh"
    found = [(k, text[a:b]) for k, a, b, _ in secrets.base_spans(text)]
    assert found == [
        ("assign", 'PassWord : "hunter22'),
        ("access", "AKIA" + "A1" * 8),
        ("hex", "deadbeef" * 3),
        ("assign", "api_key='x.y/z+1="),
    ]
    both = "token=" + "0123456789abcdef" * 2
    assert [s[:3] for s in secrets.base_spans(both)] == [("assign", 0, 38), ("hex", 6, 38)]


def test_pairs_count_runs_only():
    counts = secrets._pairs(b"abcdefgh ab abcdefg \xc3\xa9ijklmnop", 8).reshape(secrets._SIZE, -1)
    at = secrets._ALPHABET.index
    assert counts[at("a"), at("b")] == 1 and counts[at("i"), at("j")] == 1 and counts.sum() == 14


def corpus(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice(["get", "user", "name", "_", "count", "item", "list", "total"]) for _ in range(4))
    key = lambda n: "".join(rng.choice(secrets._ALPHABET[:62]) for _ in range(n))
    rows = [(k, " ".join(word() for _ in range(40)) + f" token = '{key(40)}' ") for k in range(60)]
    hidden = "B7" + key(38)
    rows.append((100, f"value {hidden} getusernamecount2_total_list_item"))
    return spark.createDataFrame(rows, "doc_id long, text string"), hidden


def test_random_strings_are_found_and_identifiers_left(spark):
    docs, hidden = corpus(spark)
    model = secrets.learn(docs)
    found = {r.id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.find(docs, model).collect()}
    assert found[100] == [(secrets.MARKOV, 6, 46)]
    assert all([s[0] for s in spans] == ["assign"] for k, spans in found.items() if k != 100)
    assert secrets.ratio(hidden, model) > 0 > secrets.ratio("getusernamecount", model)


def test_odd(odd_docs, odd_texts, no_docs):
    found = secrets.find(odd_docs, secrets.learn(odd_docs)).collect()
    assert len(found) == len(odd_texts)
    kinds = {r.id: [s.kind for s in r.spans] for r in found if r.spans}
    assert kinds == {10: ["hex"], 12: ["assign", "access"]}
    assert secrets.learn(no_docs) is None and secrets.find(no_docs, None).count() == 0


def test_the_ratio_alone_decides_on_runs_and_their_parts(spark):
    model = secrets.learn(corpus(spark)[0])
    rng = random.Random(8)
    letters = "".join(rng.choice(secrets._ALPHABET[:52]) for _ in range(24))
    key = "".join(rng.choice(secrets._ALPHABET[:62]) for _ in range(24))
    path = "get_user_name_count_item_list_total_" * 5
    hexes = "0123456789abcdef" * 2
    texts = [letters, path + key, path[:-1] + "=" + key, path + letters + "/" + path + key + "_list"]
    found = [[t[a:b] for k, a, b in secrets.find_in(t, model) if k == secrets.MARKOV] for t in texts]
    assert found[0] == [letters]
    assert all(any(key in f for f in found[k]) for k in (1, 2, 3)) and any(letters in f for f in found[3])
    assert all(len(f) < len(t) for t, some in zip(texts[1:], found[1:]) for f in some)
    # a base span is cut out of a run, and the rest is looked at
    beside = f"{hexes}/{key}"
    spans = secrets.find_in(beside, model)
    assert spans[0] == ("hex", 0, 32) and any(k == secrets.MARKOV and key in beside[a:b] for k, a, b in spans)
    assert secrets.find_in(path + "getusernamecount_item", model) == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
def test_precision_and_recall_of_what_the_models_add(spark):
    rng, rows, planted = random.Random(5), [], []
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    for k, (doc_id, text) in enumerate(texts):
        words = (text or "").split(" ")
        if k % 4 == 0:  # random letters and digits anywhere, without a pattern's words beside them
            key = "".join(rng.choice(secrets._ALPHABET[:62]) for _ in range(rng.randint(20, 40)))
            words.insert(rng.randrange(len(words) + 1), key)
            planted.append((doc_id, key))
        if k % 4 == 1:  # what looks alike and is none
            words.insert(rng.randrange(len(words) + 1), rng.choice(["4539148803436467", "internationalisation-of-texts", "get_user_name_count_item"]))
        rows.append((doc_id, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.find(docs, secrets.learn(docs)).collect()
    by_id = dict(rows)
    added = [(r.id, by_id[r.id][s.start : s.end]) for r in found for s in r.spans if s.kind == secrets.MARKOV]
    caught = sum(any(i == own and key in value for own, value in added) for i, key in planted)
    right = sum(any(i == own and key in value for own, key in planted) for i, value in added)
    assert caught >= 0.98 * len(planted) and right >= 0.98 * len(added)
