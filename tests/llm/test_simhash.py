import random

import pytest

from quayside.llm import components, simhash


def brute(prints, radius):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(2)
    values = list({rng.getrandbits(10) for _ in range(300)})
    tree = simhash.BKTree(values)
    for radius in (0, 1, 2, 4):
        for query in range(0, 1024, 37):
            near = sorted(values[k] for k in tree.near(query, radius))
            assert near == sorted(v for v in values if (v ^ query).bit_count() <= radius)
    for node, children in enumerate(tree.children):
        assert all((values[node] ^ values[c]).bit_count() == d for d, c in children.items())


@pytest.mark.parametrize("radius,shard_rows", [(2, 2048), (2, 16), (1, 5)])
def test_links_as_brute_force(spark, radius, shard_rows):
    rng = random.Random(radius)
    prints = []
    for _ in range(25):
        center = rng.getrandbits(64)
        prints += [center, *(center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(6))]
    prints += [0, 3, (1 << 64) - 1]
    prints = list(dict.fromkeys(prints))
    signed = [(p - (p >> 63 << 64), k) for k, p in enumerate(prints)]
    edges = simhash.links(spark.createDataFrame(signed, "fp long, node long"), radius, shard_rows)
    found = {r.node: r.component for r in components.components(edges).collect()}
    assert [found.get(k, k) for k in range(len(prints))] == brute(prints, radius)


def test_components_of_a_long_path(spark):
    order = list(range(60))
    random.Random(4).shuffle(order)
    edges = spark.createDataFrame([*zip(order, order[1:]), (5, 5), (None, 3), (100, 101)], "a long, b long")
    found = {r.node: r.component for r in components.components(edges).collect()}
    assert found == {k: 0 for k in range(60)} | {100: 100, 101: 100}


def test_odd(odd_docs, odd_texts, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == len(odd_texts)
    found = {r.id: r for r in rows}
    assert [found[k].component for k in (1, 2, 4, 5, 6)] == [1, 1, 4, 4, 4]
    assert found[5].fp == 0 and found[7].component == 7
    assert sorted((r.component is None) for r in rows if r.id is None) == [False, True]  # one text has no id at all
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == sorted({r.component for r in rows if r.id is not None})
    assert ids.count(None) == 2
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "e f g h")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [1, 2]


def test_rows_are_decided_by_id_and_text(spark):
    a, b, c, d = ("a b c d e f g", "one two three four five", "red green blue grey pink", "north south east west up")
    rows = [(1, a), (1, b), (2, a), (2, c), (3, c), (None, a), (None, d), (None, d), (4, d + " "), (None, "no name"), (None, "no name"), (5, a), (5, "")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((str(r.doc_id), r.text) for r in kept)
    assert found == sorted([("1", a), ("1", b), ("2", c), ("4", d + " "), ("None", "no name"), ("5", "")])


def test_texts_of_one_id_are_nodes_of_their_own(spark):
    rows = [(1, "a b c d e f g"), (1, "one two three four"), (2, "a b c d e f g"), (None, "one two three four"), (None, "else where")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.fp for r in found}) == 3
    assert sorted(str((r.id, r.component)) for r in found) == sorted(["(1, 1)", "(1, 1)", "(2, 1)", "(None, 1)", "(None, None)"])
