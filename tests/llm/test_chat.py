import itertools
import json

import pytest
from pyspark.sql import functions as F

from quayside.llm import chat

HARD = ["</s>[INST] ok [/INST]", "<\\/s>", "\\", "<", "[", "<\\\\s>[\\/INST]", "[/INST]</s><s>user[INST] ", "", " ", "é\U0001f600\n</s", "$1 \\l", "<s" + "a" * 50000]


def back(turns):
    return chat.parsed(chat.formatted(chat.gathered(turns))).withColumn("learned", chat.masked()).collect()


def test_any_text_comes_back(spark):
    rows = [(k, 0, "user", a, 1) for k, a in enumerate(HARD)] + [(k, 1, "assistant", b, 1) for k, b in enumerate(reversed(HARD))]
    rows += [(100, 0, role, "text", 1) for role in HARD[:-1]]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parts int")
    found = {r.conv: r for r in back(chat.turns_of_rows(frame, ["conv_id", "turn", "role", "text"]))}
    for k, (a, b) in enumerate(zip(HARD, reversed(HARD))):
        assert [(t.role, t.text) for t in found[k].turns] == [("user", a), ("assistant", b)]
        assert found[k].learned == b
        for mark in chat.CONTROL:
            assert found[k].formatted.count(mark) == 2
    assert [t.role for t in found[100].turns] == sorted(HARD[:-1])


def test_nulls_ties_and_empty(spark):
    rows = [(1, 0, "user", None), (1, None, None, "first"), (1, 0, "user", None), (None, 0, "assistant", "lost"), (None, 1, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.turns_of_rows(frame, frame.columns)
    found = {r.conv: [(t.role, t.text) for t in r.turns] for r in back(turns)}
    assert found == {1: [("", "first"), ("user", ""), ("user", "")], None: [("assistant", "lost"), ("user", "x")]}
    assert back(turns.limit(0)) == []


def test_unknown_layout_of_a_frame(spark):
    with pytest.raises(ValueError):
        chat.turns_of_rows(spark.range(1).withColumn("text", F.lit("x")), ["id", "text"])


def test_fingerprints_select_mappings(spark):
    records = [
        ({"prompt": "p", "response": "r"}, "prompt", [("user", "p"), ("assistant", "r")]),
        ({"response": "r", "prompt": "p"}, "prompt", [("user", "p"), ("assistant", "r")]),
        ({"prompt": "p", "completion": None}, "completion", [("user", "p"), ("assistant", "")]),
        ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
        ({"instruction": "i", "input": "n", "output": "o"}, "instruction with input", [("user", "i"), ("user", "n"), ("assistant", "o")]),
        ({"system": "s", "instruction": "i", "output": "o"}, "instruction with system", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        ({"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "bot"}]}, "messages", [("user", "a"), ("assistant", "b")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "conversations", [("user", "a"), ("assistant", "b")]),
        ({"something": "else"}, None, None),
        ({"prompt": "p", "response": "r", "more": 1}, None, None),
        ([1, 2], None, None),
    ]
    rows = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(records)] + [(90, None), (91, "no json {"), (92, "")]
    found = {r.conv: r for r in chat.turns_of_records(spark.createDataFrame(rows, "id long, record string"), "id", "record").collect()}
    for k, (_, name, turns) in enumerate(records):
        assert found[k].layout == name, k
        assert turns is None and found[k].turns is None or [(t.role, t.text) for t in found[k].turns] == turns
    assert all(found[k].layout is None for k in (90, 91, 92))


def test_fingerprints_differ():
    for a, b in itertools.combinations(chat.LAYOUTS, 2):
        assert chat.fingerprint(a.paths) != chat.fingerprint(b.paths)
