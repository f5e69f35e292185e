import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from quayside.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={}
    )


def expected(library, texts):
    return sorted(
        (str(i), np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in texts
    )


@pytest.mark.parametrize("hot_words", [0, 5, bpe.HOT_WORDS])
def test_as_the_library_and_back(odd_docs, odd_texts, library, hot_words):
    found = bpe.encode(odd_docs, PATH, public_tokenizers.PATTERN, hot_words=hot_words, decoded=True).collect()
    assert sorted((str(r.id), bytes(r.ids), bytes(r.decoded)) for r in found) == expected(library, odd_texts)


def test_decode_alone(odd_docs, odd_texts, library):
    found = bpe.decode(bpe.encode(odd_docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert sorted((str(r.id), bytes(r.ids), bytes(r.decoded)) for r in found) == expected(library, odd_texts)


def test_empty(no_docs):
    assert bpe.encode(no_docs, PATH, public_tokenizers.PATTERN, decoded=True).count() == 0


@pytest.mark.parametrize("word", [b"z" * 900, b"\xff\xfe" * 50, bytes(range(256)), b" interoperability", b"q"])
def test_long_words_merge_alike(library, word):
    ranks = bpe.load_ranks(PATH)
    assert bpe.merge_long(word, ranks) == library._core_bpe.encode_single_piece(word)


def test_words_of_a_batch_are_not_held_one_by_one():
    texts = pa.array([" ".join(f"word{k % 5000}" for k in range(n, n + 4000)) for n in range(0, 100_000, 1000)] + [None, ""])
    find = bpe.splitter(public_tokenizers.PATTERN)
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    every = [find(t or "") for t in texts.to_pylist()]
    total = sum(map(len, every))
    tracemalloc.start()
    try:
        words, which, ends = bpe._words(texts, find)
        most_words = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        counts = {r["word"]: r["n"] for b in bpe._counted(iter([batch]), find) for r in b.to_pylist()}
        most_counted = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [[words[k] for k in which[a:b]] for a, b in zip([0, *ends], ends)] == every
    assert counts == Counter(w for found in every for w in found)
    assert most_words < 25 * total and most_counted < 25 * total  # a list of all words: more than 55 bytes each


def test_texts_are_folded_a_part_at_a_time(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "SKETCH_BYTES", 100)
    texts = [(n, f"some words of text {n} " * 9) for n in range(40)]
    found = bpe.encode(spark.createDataFrame(texts, "doc_id long, text string"), PATH, public_tokenizers.PATTERN, decoded=True).collect()
    assert sorted((str(r.id), bytes(r.ids), bytes(r.decoded)) for r in found) == expected(library, texts)


def test_columns_are_split_as_single_texts(odd_texts):
    find = bpe.splitter(public_tokenizers.PATTERN)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    texts = [t for _, t in odd_texts]
    texts += ["'", "x'", "s", "'s's 't'rest 'r", "e", "it's 'll  'd\t've\n'm", " ", "a ", "  ", "  b　c", None, "", "''s"]
    texts += [every, "'s".join(every), " \n".join(every)]
    found, ends = find.column(pa.array(["it'", *texts, "s"]).slice(1, len(texts)))
    words = found.to_pylist()
    assert find.by_classes
    assert [words[a:b] for a, b in zip([0, *ends], ends)] == [find.general(t or "") for t in texts]


def test_other_patterns_split_columns_too():
    words, ends = bpe.splitter(r"\p{Lu}\p{Ll}*|\d+").column(pa.array(["OneTwo3", None, "Élan 45"]))
    assert (words.to_pylist(), ends.tolist()) == (["One", "Two", "3", "Élan", "45"], [3, 3, 5])


def sketched(batches, hot):
    ranks = bpe.load_ranks(PATH)
    return list(bpe._sketched(batches, bpe.splitter(public_tokenizers.PATTERN), hot, None, bpe._of_bytes(ranks)))


def test_rare_words_travel_once_in_a_task_and_in_small_rows():
    texts = [" ".join(f"{chr(97 + k % 26)}q{k}z" for k in range(n % 7, 30_000)) for n in range(20)]
    batches = [pa.RecordBatch.from_pydict({"id": [n], "text": [t]}) for n, t in enumerate(texts)]
    rows = [r for b in sketched(iter(batches), {}) for r in b.to_pylist()]
    rare = [tuple(w) for r in rows for w in r["rare"] or []]
    assert len(rare) > 30_000 and len(rare) == len(set(rare))
    assert max(len(w) for r in rows for w in [sum(r["rare"] or [], [])]) < 2 * bpe._ROW_BYTES


def test_numbers_of_rare_words_begin_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "SENT_BYTES", 3000)
    monkeypatch.setattr(bpe, "_ROW_BYTES", 100)
    texts = [(n, None if n % 9 == 8 else " ".join(f"w{k}rd{k * k}" for k in range(n % 5, 30 + n % 13))) for n in range(60)]
    batches = [pa.RecordBatch.from_pydict({"id": [n], "text": pa.array([t], pa.string())}) for n, t in texts]
    sent = [b for b in sketched(iter(batches), {" w1rd1": b"\1\0\0\0"}) if b.num_rows]
    assert sum(r["first"] == 0 for b in sent for r in b.to_pylist()) > 3
    ids_of = library._core_bpe.encode_single_piece
    byte_of = {int(n): b for b, n in enumerate(bpe._of_bytes(bpe.load_ranks(PATH))[0])}
    folded = [
        b.set_column(
            3, "found", pa.array([None if r is None else [ids_of(bytes(byte_of[x & bpe._LOW] for x in w)) for w in r] for r in b["rare"].to_pylist()], bpe._RARE)
        )
        for b in map(pa.Table.from_batches, ([b] for b in sent))
    ]
    together = pa.concat_tables(folded).combine_chunks().to_batches(max_chunksize=7)
    found = [r for b in bpe._filled(iter(together), None) for r in b.to_pylist()]
    one = int.from_bytes(b"\1\0\0\0", "little")
    expected_ids = {}
    for n, t in texts:
        expected_ids[n] = [i for w in bpe.splitter(public_tokenizers.PATTERN)(t or "") for i in ([one] if w == " w1rd1" else ids_of(w.encode()))]
    assert {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in found} == expected_ids


def test_the_driver_makes_no_object_of_each_frequent_word(spark):
    ranks = bpe.load_ranks(PATH)
    rows = spark.createDataFrame([(1, "qzxv qzxv"), (2, " qzxv")], "id long, text string")
    stream = bpe._hot_words(rows, public_tokenizers.PATTERN, ranks, bpe._merge_literal(ranks), 10)
    assert isinstance(stream, bytes)
    found = bpe._hot_map(stream, tuple(bpe._pieces(ranks)))
    assert np.frombuffer(found[" qzxv"], "<u4").tolist() == bpe.merge_long(b" qzxv", ranks)
    assert found[" the"] == ranks[b" the"].to_bytes(4, "little") and "qzxv" not in found
