import math
import random

import numpy as np
import pytest

from quayside.llm import capfilters


def test_decoding_finds_all_directions_in_reach():
    rng = np.random.default_rng(1)
    for dimensions in (1, 2, 7, 64):
        first, second = capfilters.codes(dimensions, 16)
        vector = rng.standard_normal(dimensions)
        vector /= np.linalg.norm(vector)
        half = first.shape[1]
        scores = ((first @ vector[:half])[:, None] + (second @ vector[half:])[None, :]) / math.sqrt(2)
        expected = np.flatnonzero(scores.ravel() >= scores.max() - 0.12)
        found = capfilters.decode(vector, first, second, 0.12)
        assert set(found) - set(expected) == set() or np.allclose(scores.ravel()[found], scores.max() - 0.12, atol=1e-9)
        assert set(expected) <= set(found) | set(np.flatnonzero(np.abs(scores.ravel() - scores.max() + 0.12) < 1e-9))


def cases(seed, centers=12, near=12):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(centers):
        center = rng.standard_normal(64)
        center /= np.linalg.norm(center)
        label = int(rng.integers(0, 3))
        for _ in range(near):
            vector = center + rng.standard_normal(64) * rng.choice([0.0, 0.01, 0.017, 0.025])
            rows.append((len(rows), [float(np.float32(x)) for x in vector * rng.uniform(0.1, 9)], label))
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(30)]
    random.Random(seed).shuffle(rows)
    return rows


def brute(rows):
    able = [k for k, (_, v, l) in enumerate(rows) if l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    units = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in able}
    for n, a in enumerate(able):
        for b in able[:n]:
            if rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.98:
                i, j = rows[a][0], rows[b][0]
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (links[i], find(i)) for i in links}


@pytest.mark.parametrize("block_rows", [capfilters.BLOCK_ROWS, 4])
def test_as_brute_force(spark, block_rows):
    nan, inf = float("nan"), float("inf")
    rows = cases(block_rows) + [
        (2000, None, 1), (2001, [0.0] * 64, 1), (2002, [0.0] * 64, 1), (2003, [nan] + [1.0] * 63, 1), (2004, [inf] + [1.0] * 63, 1),
        (2005, [None] + [1.0] * 63, 1), (2006, [1.0] * 64, None), (2007, [1.0] * 64, None), (2008, [], 1), (2009, [1.0, 0.0], 1), (2010, [3.0, 0.0], 1),
        (2011, [2.0], 1),
    ]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, links int, filter int")
    found = {r.id: (r.links, r.component) for r in capfilters.near_duplicates(frame, block_rows=block_rows).collect()}
    expected = brute(rows)
    assert sum(n for n, _ in expected.values()) > 500
    assert found == expected


def test_null_ids_and_empty(spark):
    rows = [(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (None, [9.0, -2.0], 1), (5, [1.0, 2.001], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted((str(r.id), r.links, str(r.component)) for r in capfilters.near_duplicates(frame).collect())
    assert found == [("4", 2, "4"), ("5", 2, "4"), ("None", 0, "None"), ("None", 2, "4")]
    assert capfilters.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("dimensions", [2, 8, 64, 768])
def test_recall_of_planted_pairs(dimensions):
    """Pairs just above the least cosine share a filter, whatever the dimension; codes as for 50,000 vectors."""
    rng, missed, sizes = np.random.default_rng(dimensions), 0, []
    margin = capfilters.margin_of(dimensions)
    drawn = capfilters.codes_for(dimensions, capfilters.code_width(50_000), margin)
    pairs = 400
    for _ in range(pairs):
        a, off = rng.standard_normal((2, dimensions))
        a /= np.linalg.norm(a)
        off -= off @ a * a
        b = 0.9801 * a + math.sqrt(1 - 0.9801**2) * off / np.linalg.norm(off)
        lists = [capfilters.decode(v, *drawn, margin) for v in (a, b)]
        sizes += map(len, lists)
        missed += not np.intersect1d(*lists).size
    assert missed == 0 and np.mean(sizes) < 2 * capfilters.LIST_FILTERS


@pytest.mark.parametrize("dimensions", [2, 8, 768])
def test_near_pairs_in_other_dimensions_as_brute_force(spark, dimensions):
    rng = np.random.default_rng(dimensions)
    rows = []
    for _ in range(40):
        center = rng.standard_normal(dimensions)
        for _ in range(4):
            near = center + rng.standard_normal(dimensions) * np.linalg.norm(center) / math.sqrt(dimensions) * rng.choice([0.0, 0.1, 0.19, 0.3])
            rows.append((len(rows), near.tolist(), 0))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.id: (r.links, r.component) for r in capfilters.near_duplicates(frame).collect()} == brute(rows)


def test_vectors_whose_squares_overflow_or_vanish(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1e200, 1.01e200], 1), (3, [1e-200, 1e-200], 1), (4, [-1e300, 1e300], 1), (5, [1e-320, 1e-320], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.id: (r.links, r.component) for r in capfilters.near_duplicates(frame).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1)}
