import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm import periodic, queries


def brute(words, least_words=2, least_periods=2):
    """Every maximal stretch with a smallest period, straight from the definition."""
    n, found = len(words), []
    for period in range(1, n // 2 + 1):
        at = 0
        while at + period < n:
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if length >= max(least_words, least_periods * period) and end > at:
                stretch = words[at : at + length]
                if not any(stretch[q:] == stretch[:-q] for q in range(1, period)):
                    found.append((at, length, period))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_all_runs_of_random_sequences(letters):
    rng = random.Random(letters)
    for _ in range(250):
        words = [rng.randrange(letters) for _ in range(rng.randrange(60))]
        if rng.random() < 0.6 and words:
            part = words[: rng.randrange(1, 9)]
            words += part * rng.randrange(2, 7) + [rng.randrange(letters) for _ in range(rng.randrange(12))]
        assert periodic.runs(words) == brute(words)
        assert periodic.runs(words, 6, 3) == brute(words, 6, 3)


def test_segments_are_the_last_places():
    rng = random.Random(8)
    for _ in range(60):
        words, seen = [rng.randrange(3) for _ in range(50)], periodic.LastSeen()
        for end in range(1, len(words) + 1):
            expected = set()
            for length in range(1, end):
                suffix = words[end - length : end]
                last = next((e for e in range(end - 1, length - 1, -1) if words[e - length : e] == suffix), None)
                if last is None:
                    break
                expected = {(d, l) for d, l in expected if d != end - last} | {(end - last, length)}
            got = seen.append(words[end - 1])
            assert sorted(got) == sorted((d, l) for d, l in expected if d <= l)


@pytest.mark.parametrize("least_words,least_periods", [(24, 3), (6, 3), (9, 4), (2, 2), (20, 2)])
def test_grams_lose_no_run(least_words, least_periods):
    rng, gram = random.Random(least_words), periodic.gram_words(least_words, least_periods)
    for _ in range(150):
        part = [rng.randrange(40) for _ in range(rng.randrange(1, 14))]
        tail = part * 30
        words = [rng.randrange(40) for _ in range(20)] + tail[: max(least_words, least_periods * len(part)) + rng.randrange(3)]
        words += [rng.randrange(40) for _ in range(20)]
        flags = periodic.repeated(np.array(words), np.array([len(words)]), gram)
        for start, length, _ in brute(words, least_words, least_periods):
            assert flags[start : start + length - gram + 1].all()


def plain(text, least_words=24, least_periods=3):
    words = (text or "").encode().split()
    found = brute(words, least_words, least_periods)
    dropped = {i for start, length, period in found for i in range(start + period, start + length)}
    return len(words), found, b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()


def some_texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    out = ["", None, "  \n ", "a " * 23, "a " * 24, "\tb" * 40 + " ", "x y z " * 7 + "x y z"]
    for _ in range(40):
        text = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        for _ in range(rng.randrange(4)):
            part = [rng.choice(words) for _ in range(rng.randrange(1, 12))]
            text += part * rng.randrange(2, 9) + [rng.choice(words) for _ in range(rng.randrange(30))]
        out.append(rng.choice([" ", "\n", " \x0b ", "  "]).join(text))
    return out


def test_find(spark):
    given = list(enumerate([*some_texts(), *some_texts()]))
    rows = spark.createDataFrame([(i, t, "x") for i, t in given], "doc_id long, text string, runs string")
    found = {r.id: r for r in periodic.find(rows).collect()}
    assert len(found) == len(given)
    for i, text in given:
        n, expected, left = plain(text)
        assert (found[i].n_words, [tuple(r) for r in found[i].runs], found[i].collapsed) == (n, expected, left)


def test_odd_and_empty_tables(spark, odd_docs, no_docs, odd_texts):
    found = periodic.find(odd_docs).collect()
    assert sorted(str(r.id) for r in found) == sorted(str(i) for i, _ in odd_texts)
    long = next(r for r in found if r.id == 8)
    assert [tuple(r) for r in long.runs] == [(0, 48000, 12)] and len(long.collapsed.split()) == 12
    assert periodic.find(no_docs).count() == 0
    with pytest.raises(ValueError):
        periodic.find(no_docs, least_periods=1)


def test_white_space_is_that_of_ascii_only():
    column = pa.array(["\x1ca\x1c b", " a\x0bb\x0c\r\n\tc\x85d ", None, "", "  x"])
    flat, ends = periodic._words(column)
    expected = [(t or "").encode().split() for t in column.to_pylist()]
    assert [w.encode() for w in flat.to_pylist()] == [w for ws in expected for w in ws]
    assert ends.tolist() == np.cumsum([len(ws) for ws in expected]).tolist()


def contract(doc_id, text):
    """The query's row for a document, word by word."""
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    _, found, left = plain(b" ".join(words).decode())
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{l},{p}\n" for s, l, p in found)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def test_query(spark, odd_docs, tmp_path):
    rows = [(i, t) for i, t in enumerate([*some_texts(), *some_texts()] * 3)] + [(None, "a " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_periodic(spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(str(tuple(r[c] for c in names)) for r in found.collect())
    assert got == sorted(str(contract(i, t)) for i, t in rows)
