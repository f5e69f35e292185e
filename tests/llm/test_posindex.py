import random
import re

import pytest

from quayside.llm import posindex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, width):
    found = []
    for doc_id, text in docs:
        own, hit, which = words(text), set(), set()
        for item, item_text in items:
            w = words(item_text)
            for window in {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else ():
                for at in range(len(own) - len(window) + 1):
                    if tuple(own[at : at + len(window)]) == window:
                        hit.update(range(at, at + len(window)))
                        which.add(item)
        found.append((str(doc_id), len(own), len(hit), sorted(which)))
    return sorted(found)


@pytest.mark.parametrize("segment_words", [posindex.SEGMENT_WORDS, 40])
def test_phrases_as_brute_force(spark, odd_texts, segment_words):
    rng = random.Random(9)
    docs = [(100 + k, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for k in range(40)]
    docs += [(i, t if t and len(t) < 5000 else t and t[:300]) for i, t in odd_texts] + [(100, "a b A, c-d")]
    items = [("i1", "a b c d a"), ("i2", "d"), ("i3", None), ("i4", "..."), ("i5", "b a b a"), ("i6", "café 中文")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("doc_id", "k")
    phrases = posindex.phrases_of(items, 4)
    found = posindex.search(posindex.build(frame, "k", segment_words=segment_words), phrases).collect()
    assert sorted((str(r.id), r.n_words, r.n_hit, r.items) for r in found) == brute(docs, items, 4)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x green y blue"), (2, "red " + "x " * 30 + "green blue"), (3, "blue green red")], "doc_id long, text string")
    phrases = posindex.phrases_of([("c", "red green blue")], 10)
    found = {r.id: (r.items, r.near_items) for r in posindex.search(posindex.build(docs), phrases, span=6).collect()}
    assert found == {1: ([], ["c"]), 2: ([], []), 3: ([], ["c"])}


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([("a", "x y"), ("a", "x y"), (None, "z"), ("b", None)], "item_id string, text string")
    asked = posindex.windows(items, "item_id", "text", 10)
    index = posindex.build(odd_docs)
    found = posindex.search_windows(index, asked).collect()
    assert len(found) == odd_docs.count() and not any(r.items for r in found)
    assert posindex.search_windows(posindex.build(no_docs), asked).count() == 0
    for span in (-1, posindex.GAP):
        with pytest.raises(ValueError):
            posindex.search_windows(index, asked, span)


@pytest.mark.parametrize("limits", [(1 << 17, 1 << 24), (3, 1 << 24), (1 << 17, 40)])
def test_windows_in_blocks_as_brute_force(spark, limits):
    rng = random.Random(10)
    docs = [(100 + k, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for k in range(40)]
    docs += [(100, "a b A, c-d"), (None, "b a b a b"), (None, None), (7, "café 中文 x")]
    items = [("i1", "a b c d a"), ("i1", "d c b a"), ("i2", "d"), ("i3", None), ("i4", "..."), ("i5", "b a b a"), ("i6", "café 中文"), ("i7", "a b c d a b c d")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = posindex.windows(spark.createDataFrame(items, "item_id string, text string"), "item_id", "text", 4)
    found = posindex.search_windows(posindex.build(frame, segment_words=40), asked, None, *limits).collect()
    assert sorted((str(r.id), r.n_words, r.n_hit, r.items) for r in found) == brute(docs, items, 4)
    assert all(r.near_items is None for r in found)


def test_near_items_of_blocks(spark):
    docs = spark.createDataFrame([(1, "red x x green y blue"), (2, "red " + "x " * 30 + "green blue"), (3, "blue green red")], "doc_id long, text string")
    items = spark.createDataFrame([("c", "red green blue"), ("d", "green y"), ("e", "x x")], "item_id string, text string")
    asked = posindex.windows(items, "item_id", "text", 10)
    found = {r.id: (r.items, r.near_items) for r in posindex.search_windows(posindex.build(docs), asked, 6, 1).collect()}
    assert found == {1: (["d", "e"], ["c", "d", "e"]), 2: (["e"], ["e"]), 3: ([], ["c"])}


def test_an_item_without_a_name_counts_as_a_hit(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "c d")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b"), ("n", "d"), ("n", None)], "item_id string, text string")
    asked = posindex.windows(items, "item_id", "text", 10)
    for block in (1, 10):
        found = {r.id: (r.n_hit, r.items) for r in posindex.search_windows(posindex.build(docs), asked, None, block).collect()}
        assert found == {1: (2, []), 2: (1, ["n"])}
    assert posindex.search_windows(posindex.build(docs.limit(0)), asked, None, 1).count() == 0
    assert {r.n_hit for r in posindex.search_windows(posindex.build(docs), asked.limit(0)).collect()} == {0}
