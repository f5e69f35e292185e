import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm import packing, queries
from quayside.llm.common import snapshot

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(lengths, capacity, weights, rule):
    """Best fit as the docstring says it, sequence by sequence."""
    placed, open_ones = [], []
    for length in lengths:
        demand, best = (length, 1, length * length), None
        for number, used in enumerate(open_ones):
            room = [c - u for c, u in zip(capacity, used)]
            if any(d > r for d, r in zip(demand, room)):
                continue
            if rule == "norm":
                score = -sum(w * ((r - d) / c) ** 2 for w, r, d, c in zip(weights, room, demand, capacity))
            else:
                score = sum(w * d / c * r / c for w, r, d, c in zip(weights, room, demand, capacity))
            if best is None or score > best[0] + 1e-15:
                best = score, number
        if best is None:
            open_ones.append((0, 0, 0))
            best = 0, len(open_ones) - 1
        used = open_ones[best[1]]
        placed.append((best[1], used[0]))
        open_ones[best[1]] = tuple(u + d for u, d in zip(used, demand))
    return placed


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("documents,attention", [(None, None), (3, None), (None, 2000), (4, 3000)])
def test_rules_and_constraints(rule, documents, attention):
    rng = random.Random(f"{rule}{documents}{attention}")
    capacity = packing.capacities(64, documents, attention)
    for weights in (packing.WEIGHTS, packing.Vector(1, 0.5, 0.25)):
        lengths = sorted((rng.randrange(1, 45) for _ in range(150)), reverse=True)
        own = packing.Sequences(capacity, weights, rule)
        placed = [own.place(n) for n in lengths]
        assert placed == plain(lengths, capacity, weights, rule)
        held = defaultdict(list)
        for (number, _), length in zip(placed, lengths):
            held[number].append(length)
        for inside in held.values():
            assert sum(inside) <= 64 and len(inside) <= capacity.documents
            assert sum(n * n for n in inside) <= capacity.attention


def test_more_sequences_than_the_first_arrays_hold():
    own = packing.Sequences(packing.capacities(10))
    assert [own.place(6)[0] for _ in range(3000)] == list(range(3000))
    assert [own.place(4) for _ in range(3000)] == [(k, 6) for k in range(3000)]
    assert own.open == 0


def whole(rows, texts, end_id, tokens):
    """Each piece once, right ids and places; sequences without gaps and within their tokens."""
    library = Tokenizer.from_file(PATH)
    expected, got, used = [], [], defaultdict(list)
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        for piece, start in enumerate(range(0, len(ids), tokens)):
            part = np.array(ids[start : start + tokens], "<u4")
            expected.append(str((doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))))
    for r in rows:
        got.append(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)))
        used[r.sequence_id].append((r.offset, r.length))
    assert sorted(got) == sorted(expected)
    for inside in used.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= tokens
    return len(used), sum(n for inside in used.values() for _, n in inside)


def test_query(spark, odd_docs, odd_texts, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    sequences, total = whole(queries.op11_packing(spark, str(tmp_path)).collect(), odd_texts, 0, 2048)
    assert sequences <= -(-total // 2048) + 1


def test_several_tasks_and_sequences(spark, odd_docs, odd_texts):
    found = snapshot(packing.pieces(odd_docs, PATH, 0, 50), "pieces")
    placed = snapshot(packing.pack(found, packing.capacities(50, 4), task_tokens=2000), "placed")
    tasks = {r.sequence >> 40 for r in placed.collect()}
    assert len(tasks) > 1
    library = Tokenizer.from_file(PATH)
    pieces = {r.row: r.id for r in found.collect()}
    got = defaultdict(list)
    for s in packing.sequences(found, placed).collect():
        ids, at = np.frombuffer(bytes(s.ids), "<u4"), 0
        assert len(s.lengths) == len(s.row_ids) <= 4 and sum(s.lengths) == len(ids) <= 50
        for length, doc_id in zip(s.lengths, s.row_ids):
            got[str(doc_id)].append(tuple(ids[at : at + length].tolist()))
            at += length
    expected = defaultdict(list)
    for doc_id, text in odd_texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected[str(doc_id)] += [tuple(ids[k : k + 50]) for k in range(0, len(ids), 50)]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    assert len(pieces) == len(odd_texts)


def test_empty_and_refused(spark, no_docs, odd_docs):
    empty = snapshot(packing.pieces(no_docs, PATH, 0, 2048), "pieces")
    placed = packing.pack(empty, packing.capacities(2048))
    assert placed.count() == 0 and packing.sequences(empty, placed).count() == 0
    found = snapshot(packing.pieces(odd_docs, PATH, 0, 100), "pieces")
    with pytest.raises(ValueError):
        packing.pack(found, packing.capacities(100, None, 9999))
    with pytest.raises(ValueError):
        packing.pack(found, packing.capacities(100), rule="first")
